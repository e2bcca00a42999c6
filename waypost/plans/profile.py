"""Profile of recorded vectors before any model touches them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waypost.functions.scalar import dedup_key
from waypost.operators.ranks import percentile_by_index
from waypost.schemas import VECTOR_FIELDS
from waypost.sources.polls import CAPTURE_ORDER
from waypost.workspace import settle

STALE_SECONDS = 10


_FIELDS = [name for name, _, _ in VECTOR_FIELDS]


def _by_width(polls: DataFrame) -> DataFrame:
    """Rows, and nulls of every vector field, per number of elements."""
    return polls.groupBy(F.size("v").alias("width")).agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.count_if(F.get(F.col("v"), F.lit(i)).isNull() & (F.size("v") > i)).alias(name)
            for i, name in enumerate(_FIELDS)
        ],
    )


def _rates(by_width: DataFrame) -> DataFrame:
    counts = by_width.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows", *_FIELDS)])
    return counts.unpivot("rows", _FIELDS, "field", "nulls").select(
        "field", "nulls", F.try_divide(F.col("nulls") * 100.0, "rows").alias("null_pct")
    )


def null_rates(polls: DataFrame) -> DataFrame:
    """Percentage of rows in which each vector field is null, sensors included."""
    return _rates(_by_width(polls))


def duplicate_rates(vectors: DataFrame) -> DataFrame:
    """Rows, repeats and repeat rate overall, on the ground and in the air.

    A row repeats an observation if its key was seen earlier in capture order, and
    counts for its own population. All rows of a key but its first are repeats, so
    counts per key and the first row's population are enough: no key's copies are
    ever listed.
    """
    keyed = vectors.withColumn("key", dedup_key("icao24", "time_position", "last_contact"))
    per_key = keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("on_ground").alias("ground"),
        F.min_by("on_ground", F.struct(*CAPTURE_ORDER)).alias("first_on_ground"),
    )
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("all_rows"),
        F.coalesce(F.sum("ground"), F.lit(0)).alias("ground_rows"),
        F.count(F.lit(1)).alias("all_first"),
        F.count_if("first_on_ground").alias("ground_first"),
    )
    rows = F.array(
        F.struct(F.lit("overall").alias("population"), F.col("all_rows").alias("rows"),
                 (F.col("all_rows") - F.col("all_first")).alias("duplicates")),
        F.struct(F.lit("on_ground").alias("population"), F.col("ground_rows").alias("rows"),
                 (F.col("ground_rows") - F.col("ground_first")).alias("duplicates")),
        F.struct(
            F.lit("airborne").alias("population"),
            (F.col("all_rows") - F.col("ground_rows")).alias("rows"),
            (F.col("all_rows") - F.col("ground_rows") - F.col("all_first") + F.col("ground_first"))
            .alias("duplicates"),
        ),
    )
    return totals.select(F.inline(rows)).withColumn(
        "duplicate_pct",
        F.coalesce(F.col("duplicates") * 100.0 / F.nullif(F.col("rows"), F.lit(0)), F.lit(0.0)),
    )


def poll_intervals(envelopes: DataFrame) -> DataFrame:
    """Number of polls and mean seconds between them, in capture order.

    The differences telescope: last time minus first, over the number of steps.
    """
    order = F.struct("file", "poll_time")
    return envelopes.agg(
        F.count(F.lit(1)).alias("polls"),
        F.try_divide(
            F.max_by("poll_time", order) - F.min_by("poll_time", order), F.count(F.lit(1)) - 1
        ).alias("mean_interval_s"),
    )


def staleness(vectors: DataFrame) -> DataFrame:
    """Fix age in seconds, for vectors with a fix."""
    return vectors.where(F.col("time_position").isNotNull()).select(
        (F.col("last_contact") - F.col("time_position")).alias("age")
    )


def profile(envelopes: DataFrame, polls: DataFrame, vectors: DataFrame) -> DataFrame:
    """The whole profile as ``(metric, value)`` rows.

    The recordings are read three times: once per argument. What several measures need
    of the vectors is written narrow, and widths and nulls come from one aggregate.
    """
    vectors = settle(
        vectors.select("icao24", "time_position", "last_contact", "on_ground", *CAPTURE_ORDER), "profile-vectors"
    )
    by_width = settle(_by_width(polls), "profile-widths")  # a row per number of elements
    intervals = poll_intervals(envelopes).select(
        F.inline(
            F.array(
                F.struct(F.lit("polls").alias("metric"), F.col("polls").cast("double").alias("value")),
                F.struct(F.lit("mean_interval_s").alias("metric"), F.col("mean_interval_s").alias("value")),
            )
        )
    )
    widths = by_width.select(
        F.concat(F.lit("vectors_with_fields_"), F.col("width").cast("string")).alias("metric"),
        F.col("rows").cast("double").alias("value"),
    )
    duplicates = duplicate_rates(vectors).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.concat(F.lit(f"{name}_"), F.col("population")).alias("metric"),
                        F.col(name).cast("double").alias("value"),
                    )
                    for name in ("rows", "duplicates", "duplicate_pct")
                ]
            )
        )
    )
    ages = staleness(vectors)
    percentiles = percentile_by_index(ages, "age", [50, 90, 99]).select(
        F.concat(F.lit("staleness_p"), F.col("p").cast("int").cast("string")).alias("metric"),
        F.col("value").cast("double").alias("value"),
    )
    shares = ages.agg(
        F.coalesce(F.max("age"), F.lit(0)).cast("double").alias("top"),
        F.coalesce(
            F.try_divide(F.count_if(F.col("age") > STALE_SECONDS) * 100.0, F.count(F.lit(1))), F.lit(0.0)
        ).alias("stale"),
    ).select(
        F.inline(
            F.array(
                F.struct(F.lit("staleness_max").alias("metric"), F.col("top").alias("value")),
                F.struct(F.lit("staleness_over_10s_pct").alias("metric"), F.col("stale").alias("value")),
            )
        )
    )
    nulls = _rates(by_width).select(
        F.concat(F.lit("null_pct_"), F.col("field")).alias("metric"), F.col("null_pct").alias("value")
    )
    return reduce(DataFrame.unionByName, [intervals, widths, duplicates, percentiles, shares, nulls])
