"""Silver kept up to date per micro-batch, late rows included."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from waypost import schemas
from waypost.functions.scalar import partition_date, partition_hour
from waypost.operators.dedup import dedup_latest
from waypost.streaming.runs import merge_runs, read_runs, write_run
from waypost.workspace import children, delete

KEYS = ("icao24", "observed_at")
VERSION = "ingested_at"
TIE_BREAKERS = ("poll_time", "last_contact")

HOUR = ["date", "hour"]

#: Batches that add to an hour before it is written as one snapshot.
DELTAS = 16

_STORED = T.StructType(
    [
        *schemas.BRONZE.fields,
        T.StructField("source_row_count", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("batch", T.LongType()),
    ]
)

#: What each batch wrote of each hour: its own rows, or with ``whole`` all of the hour.
_MANIFEST = T.StructType(
    [*[f for f in _STORED.fields if f.name in (*HOUR, "batch")], T.StructField("whole", T.BooleanType())]
)


def _in_use(manifest: DataFrame) -> DataFrame:
    """The newest snapshot of each hour and what was added since, with their number ``n``."""
    snapshot = F.max(F.when(F.col("whole"), F.col("batch")))
    files = manifest.groupBy(*HOUR).agg(
        snapshot.alias("_base"), F.collect_set(F.struct("batch", "whole")).alias("_files")
    )
    kept = F.filter("_files", lambda f: F.col("_base").isNull() | (f["batch"] >= F.col("_base")))
    return files.select(*HOUR, F.size(kept).alias("n"), F.inline(kept))


def _files(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    return _in_use(read_runs(spark, f"{path}/manifest", _MANIFEST, before))


def _rows(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    # A clock hour has no more than DELTAS files and a snapshot in use.
    stored = spark.read.schema(_STORED).parquet(f"{path}/hours")
    return stored.join(F.broadcast(files.select(*HOUR, "batch", "n")), [*HOUR, "batch"])


def _resolved(rows: DataFrame) -> DataFrame:
    """The latest copy of every observation; an hour in one file is so already."""
    columns = [*schemas.BRONZE_COLUMNS, "source_row_count"]
    alone = rows.where("n = 1").select(*columns)
    several = rows.where("n > 1").select(*columns)
    return alone.unionByName(dedup_latest(several, KEYS, VERSION, TIE_BREAKERS, count_col="source_row_count"))


def read_latest(spark: SparkSession, path: str, since: dt.datetime | None = None) -> DataFrame:
    """Latest copy of every observation, with the number of copies; from ``since`` on if given."""
    if not children(spark, f"{path}/hours"):
        raise FileNotFoundError(f"nothing merged at {path}")
    rows = _rows(spark, path, _files(spark, path))
    if since is not None:
        rows = rows.where((F.col("date") >= F.to_date(F.lit(since))) & (F.col("observed_at") >= F.lit(since)))
    return _resolved(rows)


def read_hours(spark: SparkSession, path: str, hours: DataFrame, before: int | None = None) -> DataFrame:
    """``read_latest`` of some hours (``date`` and ``hour``, a row per clock hour at most)."""
    files = _files(spark, path, before).join(F.broadcast(hours.select(*HOUR).distinct()), HOUR)
    return _resolved(_rows(spark, path, files))


def merge_latest(bronze: DataFrame, path: str, batch_id: int) -> None:
    """Add a batch to the hours it touches.

    Its observations, each in its latest copy, go to ``hours/date=.../hour=.../batch=<id>``,
    so what is written follows the batch and not the hour; readers resolve copies across
    batches. An hour that ``DELTAS`` batches have added to is written as one snapshot
    instead. The manifest names it last. A retried batch overwrites its own files only, so
    merging is idempotent and readers never see half of it. ``drop_superseded`` removes
    what snapshots have replaced.
    """
    spark = bronze.sparkSession
    arrived = dedup_latest(bronze, KEYS, VERSION, TIE_BREAKERS).withColumns(
        {"date": F.to_date("observed_at"), "hour": F.hour("observed_at")}
    )
    arrived = arrived.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = arrived.select(*HOUR).distinct()
        before = _files(spark, path, before=batch_id)
        full = before.where(F.col("n") > DELTAS).join(F.broadcast(touched), HOUR, "left_semi")
        full = full.persist(StorageLevel.MEMORY_AND_DISK)
        rows = arrived
        if not full.isEmpty():
            due = F.broadcast(full.select(*HOUR).distinct())
            earlier = _rows(spark, path, full).select(*arrived.columns)
            again = arrived.join(due, HOUR, "left_semi").unionByName(earlier).drop(*HOUR)
            whole = dedup_latest(again, KEYS, VERSION, TIE_BREAKERS, count_col="source_row_count")
            rows = arrived.join(due, HOUR, "left_anti").unionByName(
                whole.withColumns({"date": F.to_date("observed_at"), "hour": F.hour("observed_at")})
            )
        (
            rows.withColumns({"date": partition_date(), "hour": partition_hour(), "batch": F.lit(batch_id)})
            .hint("rebalance", *HOUR)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(*HOUR, "batch")
            .parquet(f"{path}/hours")
        )
        due = full.select(*HOUR, F.lit(True).alias("whole")).distinct()
        named = touched.join(F.broadcast(due), HOUR, "left").select(
            *HOUR, F.lit(batch_id).cast("bigint").alias("batch"), F.coalesce("whole", F.lit(False)).alias("whole")
        )
        write_run(named.coalesce(1), f"{path}/manifest", batch_id, batch_id)
        full.unpersist()
        merge_runs(
            spark, f"{path}/manifest", _MANIFEST, batch_id,
            lambda m: _in_use(m).select(*_MANIFEST.fieldNames()).coalesce(1), whole=True,
        )
    finally:
        arrived.unpersist()


def drop_superseded(spark: SparkSession, path: str) -> None:
    """Delete what snapshots have replaced. Run while no reader is on it."""
    newest = read_runs(spark, f"{path}/manifest", _MANIFEST).where("whole").groupBy(*HOUR).agg(F.max("batch").alias("batch"))
    for hour in newest.collect():  # a row per clock hour at most
        folder = f"{path}/hours/date={hour.date.isoformat()}/hour={hour.hour:02d}"
        for name in children(spark, folder):
            if name.startswith("batch=") and int(name[6:]) < hour.batch:
                delete(spark, f"{folder}/{name}")


def start_silver(
    bronze: DataFrame, path: str, checkpoint: str, bounded: bool = True
) -> StreamingQuery:
    trigger = {"availableNow": True} if bounded else {"processingTime": "30 seconds"}
    return (
        bronze.writeStream.foreachBatch(lambda batch, n: merge_latest(batch, path, n))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def stream_bronze(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Bronze Parquet, in either layout, as a stream of new files."""
    reader = spark.readStream.schema(schemas.BRONZE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path).select(*schemas.BRONZE_COLUMNS)
