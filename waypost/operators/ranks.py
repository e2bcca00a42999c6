"""Exact order statistics without a global sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waypost.workspace import settle


def percentile_by_index(
    df: DataFrame, col: str, percents: Sequence[float], approx: bool = False
) -> DataFrame:
    """Value at index ``min(floor(n * p / 100), n - 1)`` of the sorted column.

    ``col`` is a column of any ordered number type; NULLs do not count and NaN sorts
    last. Returns ``(p, value)`` in the column's type (whole numbers as long), with
    value 0 for an empty column. ``approx`` gives Spark's approximate percentiles
    instead, for a look at very many distinct values.

    Works on counts per value, range-partitioned by value and written. A running sum
    over the partitions' totals, one row each, tells which partition an index falls
    into, and a running sum inside that partition finds the value. A hot value is one
    row from each map task on.
    """
    spark = df.sparkSession
    whole = df.schema[col].dataType.typeName() in ("byte", "short", "integer", "long")
    kind = "bigint" if whole else df.schema[col].dataType.simpleString()
    wanted = F.array(*[F.lit(float(p)) for p in percents])
    asked = spark.range(1).select(F.explode(wanted).alias("p"))
    values = df.select(F.col(col).cast(kind).alias("value")).where(F.col("value").isNotNull())

    if approx:
        found = values.agg(F.percentile_approx("value", [p / 100 for p in percents]).alias("value"))
        picked = found.select(wanted.alias("p"), "value").select(F.inline(F.arrays_zip("p", "value")))
    else:
        counts = settle(
            values.groupBy("value")
            .agg(F.count(F.lit(1)).alias("n"))
            .repartitionByRange("value")
            .withColumn("block", F.spark_partition_id()),
            "value-counts",
        )
        in_order = W.orderBy("block").rowsBetween(W.unboundedPreceding, W.currentRow)
        everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        blocks = (
            counts.groupBy("block")
            .agg(F.sum("n").alias("n"))
            .withColumns({"upto": F.sum("n").over(in_order), "total": F.sum("n").over(everything)})
        )
        here = (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))
        targets = (
            blocks.withColumn("p", F.explode(wanted))
            .withColumn(
                "rank",
                F.least(F.floor(F.col("total") * F.col("p") / 100), F.col("total") - 1),
            )
            .where(here)
            .select("block", "p", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"))
        )
        inside = W.partitionBy("p").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
        picked = (
            counts.join(F.broadcast(targets), "block")  # one row per requested percentile
            .withColumn("upto", F.sum("n").over(inside))
            .where(here)
            .select("p", "value")
        )
    return asked.join(picked, "p", "left").select("p", F.coalesce("value", F.lit(0).cast(kind)).alias("value"))
