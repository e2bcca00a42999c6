"""Tables bucketed by key and time slice, over which per-key jobs move no rows.

A job that windows a history slice by slice needs the rows of a key's slice in one task.
In a table bucketed by both they lie together when it is read, so deduplication and
sessions over it shuffle only their summaries, a row per key and slice. A key with a
third of all rows has many slices and is spread over the buckets like any others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waypost.operators.scans import DAY, time_slice

#: Column with the slice a row belongs to, part of the bucket key.
SLICE = "time_slice"

#: Buckets of a table. Choose rows / BUCKETS such that a bucket fits a task's memory.
BUCKETS = 64


def write_bucketed(
    df: DataFrame,
    name: str,
    path: str,
    key: str = "icao24",
    ts: str = "observed_at",
    buckets: int = BUCKETS,
    slice_s: int = DAY,
) -> DataFrame:
    """Write ``df`` with its ``time_slice`` as the external table ``name`` and read it.

    Rows are first dealt by the bucket key, so a bucket is one file. Where ``df`` has the
    column already it comes from such a table, whose rows lie as they should, and nothing
    is dealt again. Rows with a null key or time form slices of their own; a table of
    that name is replaced, other columns are kept as they are, and no rows give an empty
    table.
    """
    if SLICE not in df.columns:
        df = df.withColumn(SLICE, time_slice(ts, slice_s)).repartition(buckets, key, SLICE)
    (
        df.sortWithinPartitions(key, SLICE, ts)
        .write.mode("overwrite")
        .bucketBy(buckets, key, SLICE)
        .sortBy(key, SLICE, ts)
        .option("path", path)
        .option("compression", "zstd")
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def open_bucketed(
    spark: SparkSession,
    name: str,
    path: str,
    schema: str,
    key: str = "icao24",
    ts: str = "observed_at",
    buckets: int = BUCKETS,
) -> DataFrame:
    """A bucketed table that another application wrote, where catalogs are not shared.

    ``schema`` is DDL and includes ``time_slice``; ``buckets`` must be what it was
    written with, or rows would be taken to lie where they do not.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet "
        f"CLUSTERED BY ({key}, {SLICE}) SORTED BY ({key}, {SLICE}, {ts}) INTO {int(buckets)} BUCKETS "
        f"LOCATION '{path}'"
    )
    return spark.table(name)
