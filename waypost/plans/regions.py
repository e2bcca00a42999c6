"""What each region's polls returned and cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waypost.operators.boxes import bbox_cost
from waypost.operators.scans import ewma, running_total, sessionize
from waypost.params import DAILY_QUOTAS, EWMA_ALPHA, STALENESS_CEILING_SECONDS
from waypost.workspace import settle


def poll_gaps(polls: DataFrame, ceiling_s: int = STALENESS_CEILING_SECONDS) -> DataFrame:
    """Polls (``region``, ``poll_time``) with the gap before each and a breach flag."""
    return sessionize(polls, ["region"], "poll_time", ceiling_s).select(
        *polls.columns,
        F.col("seconds_since_previous").alias("gap_s"),
        F.coalesce(F.col("seconds_since_previous") > ceiling_s, F.lit(False)).alias("breach"),
    )


def worst_gaps(polls: DataFrame, ceiling_s: int = STALENESS_CEILING_SECONDS) -> DataFrame:
    return (
        poll_gaps(polls, ceiling_s)
        .groupBy("region")
        .agg(F.max("gap_s").alias("worst_gap_s"), F.count_if("breach").alias("breaches"))
    )


def quota_ledger(polls: DataFrame, quota: int = DAILY_QUOTAS["registered"]) -> DataFrame:
    """Credits spent so far per UTC day after each poll (``region``, ``poll_time``, ``cost``)."""
    by_day = polls.withColumn("day", F.to_date("poll_time"))
    spent = running_total(by_day, ["day"], "poll_time", ["region"], "cost", "spent")
    return spent.withColumns(
        {
            "remaining": F.lit(quota) - F.col("spent"),
            "over_quota": F.col("spent") > quota,
        }
    )


def region_yield(polls: DataFrame, regions: DataFrame, alpha: float = EWMA_ALPHA) -> DataFrame:
    """Polls, cost, smoothed vectors, vectors per credit and worst gap per region.

    ``polls`` has ``region``, ``poll_time`` and ``vectors``; its lineage runs once.
    """
    polls = settle(polls.select("region", "poll_time", "vectors"), "region-polls")
    smoothed = ewma(polls, "region", "poll_time", "vectors", alpha)
    yields = smoothed.groupBy("region").agg(
        F.count(F.lit(1)).alias("polls"), F.max_by("ewma", "poll_time").alias("yield")
    )
    costs = bbox_cost(regions).select(F.col("name").alias("region"), "cost")
    return (
        yields.join(worst_gaps(polls), "region")
        .join(costs, "region")
        .select(
            "region", "polls", "cost", "yield",
            (F.col("yield") / F.col("cost")).alias("yield_per_credit"),
            "worst_gap_s", "breaches",
        )
    )
