"""Mergeable counts per aircraft, hour and region, exact ones of distinct observations included.

An observation is an aircraft and a second, so the seconds of an hour in which it was seen
are 3,600 bits. Bits of different batches are joined by ``or``: a copy that comes again
sets the bit it had set before. A table of these answers the headline and the statistics
of any hours without a pass over bronze.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waypost.streaming.runs import merge_runs, read_runs, write_run

KEYS = ("icao24", "hour", "region")

PARTIALS = T.StructType(
    [
        T.StructField("icao24", T.StringType()),
        T.StructField("hour", T.TimestampType()),
        T.StructField("region", T.StringType()),
        T.StructField("copies", T.LongType()),
        T.StructField("last_seen", T.TimestampType()),
        T.StructField("seen", T.BinaryType()),
    ]
)

#: Bytes with a bit for each second of an hour; Spark's own bitmaps are longer.
_HOUR_BYTES = 450


#: Rows with bitmaps that a task merges, as they are sorted. Sizes of shuffles do not tell:
#: most bitmaps are nearly empty and shrink to a tenth or less.
TASK_ROWS = 100_000


def _dealt(partials: DataFrame, *keys: str) -> DataFrame:
    return partials.repartition(max(1, -(-partials.count() // TASK_ROWS)), *keys)


def _trimmed(bitmap):
    return F.substring(bitmap, 1, _HOUR_BYTES)


def observation_partials(bronze: DataFrame) -> DataFrame:
    """Counts of a batch, or of all of bronze, in one pass over four of its columns.

    A null region is a group of its own. ``icao24`` and ``observed_at`` are never null in
    bronze; a row without a time would be counted as a copy only. No rows give no rows.

    The narrow rows are shuffled, not bitmaps: while they are built those take 4 KB each,
    and few copies share one.
    """
    second = F.minute("observed_at") * 60 + F.second("observed_at")
    return (
        bronze.select("icao24", F.date_trunc("hour", "observed_at").alias("hour"), "region", "observed_at")
        .repartition(*KEYS)
        .groupBy(*KEYS)
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.max("observed_at").alias("last_seen"),
            _trimmed(F.bitmap_construct_agg(second)).alias("seen"),
        )
        .select(*PARTIALS.fieldNames())
    )


def merge_partials(partials: DataFrame) -> DataFrame:
    """One row per aircraft, hour and region again."""
    return (
        _dealt(partials, *KEYS)
        .groupBy(*KEYS)
        .agg(
            F.sum("copies").alias("copies"),
            F.max("last_seen").alias("last_seen"),
            _trimmed(F.bitmap_or_agg("seen")).alias("seen"),
        )
        .select(*PARTIALS.fieldNames())
    )


def add_partials(bronze: DataFrame, path: str, batch: int) -> None:
    """The counts of a batch as a run; runs are merged every so many batches.

    A batch that is written again replaces its run.
    """
    write_run(observation_partials(bronze), path, batch, batch)
    merge_runs(bronze.sparkSession, path, PARTIALS, batch, merge_partials)


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    return read_runs(spark, path, PARTIALS)


def _by_hour(partials: DataFrame) -> DataFrame:
    """Regions joined: an observation polled for two of them is one."""
    return _dealt(partials, "icao24", "hour").groupBy("icao24", "hour").agg(
        F.sum("copies").alias("copies"),
        F.max("last_seen").alias("last_seen"),
        F.bitmap_count(F.bitmap_or_agg("seen")).alias("observations"),
    )


def headline(partials: DataFrame) -> DataFrame:
    """Rows, observations, aircraft, the newest observation and the regions; one row.

    ``partials`` is read twice; pass a written table.
    """
    regions = partials.agg(F.sort_array(F.collect_set("region"))).scalar()
    return _by_hour(partials).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum("observations"), F.lit(0)).alias("distinct_observations"),
        F.count_distinct("icao24").alias("distinct_aircraft"),
        F.max("last_seen").alias("latest_observation"),
    ).withColumn("regions", regions)


def hour_stats(partials: DataFrame) -> DataFrame:
    """``partition_stats`` of every hour: rows, distinct aircraft and duplicate rows."""
    return (
        _by_hour(partials)
        .groupBy("hour")
        .agg(
            F.sum("copies").alias("rows"),
            F.count(F.lit(1)).alias("distinct_aircraft"),
            F.sum(F.col("copies") - F.col("observations")).alias("duplicate_rows"),
        )
    )
