"""Batch writers. Layouts follow event time; hot partitions are split, not funnelled."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waypost import schemas
from waypost.functions.scalar import partition_date, partition_hour
from waypost.params import BRONZE_RETENTION_DAYS, METRICS_RETENTION_DAYS
from waypost.sources.tables import utc
from waypost.workspace import children, claim, delete, release, settle, shared_root

#: Of files of text and JSON, which take several times the space of the tables made from them.
TEXT_CODEC = "lz4"


def _bronze_layout(df: DataFrame) -> DataFrame:
    return df.select(*schemas.BRONZE_COLUMNS).withColumns(
        {"date": partition_date(), "hour": partition_hour()}
    )


def _write_partitions(df: DataFrame, path: str, keys: Sequence[str], mode: str, batch: int | None) -> None:
    """Partitioned Parquet. With a batch number, the batch's own folders are replaced.

    ``batch=<number>`` is the innermost folder, so a batch that is written again
    after a failure leaves each of its rows once.
    """
    if batch is not None:
        df, keys, mode = df.withColumn("batch", F.lit(batch).cast("bigint")), [*keys, "batch"], "overwrite"
    writer = df.write.mode(mode).partitionBy(*keys).option("compression", "zstd")
    if batch is not None:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_bronze(df: DataFrame, path: str, mode: str = "append", batch: int | None = None) -> None:
    """Append Parquet under ``date=YYYY-MM-DD/hour=HH`` of ``observed_at`` (UTC).

    A stale fix lands in the hour it was observed. The rebalance groups each hour
    into few files and, unlike a hash repartition, splits an hour that is too
    large for one task. One path takes either batches with numbers or plain appends.
    """
    laid_out = _bronze_layout(df).hint("rebalance", "date", "hour")
    _write_partitions(laid_out, path, ["date", "hour"], mode, batch)


def write_bronze_table(df: DataFrame, path: str, mode: str = "append", batch: int | None = None) -> None:
    """Day partitions clustered by aircraft and time, for the query side.

    Range partitioning on all three columns lets a hot day, or a hot aircraft
    within it, spread over tasks while files keep tight min/max statistics.
    """
    laid_out = (
        df.select(*schemas.BRONZE_COLUMNS)
        .withColumn("day", partition_date())
        .repartitionByRange("day", "icao24", "observed_at")
        .sortWithinPartitions("day", "icao24", "observed_at")
    )
    _write_partitions(laid_out, path, ["day"], mode, batch)


class FanoutError(RuntimeError):
    """Some targets of a batch failed."""


def write_fanout(
    df: DataFrame,
    targets: Mapping[str, Callable[[DataFrame], None]],
    on_partial: str = "fail",
    stored: bool = False,
) -> dict[str, str | None]:
    """Give one batch to every target; all are tried, then failures are reported.

    The batch is persisted meanwhile, so that it is computed once and all targets get
    the same rows; ``stored`` says that it is read from a table and needs no copy.
    Returns the error text per target, None for a success. ``on_partial="fail"``
    raises when any target failed, so that the batch is retried whole;
    ``"continue"`` raises only when all did.
    """
    if on_partial not in ("fail", "continue"):
        raise ValueError(f"unknown on_partial {on_partial!r}")
    outcome: dict[str, str | None] = {}
    held = not stored and not df.is_cached
    if held:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, write in targets.items():
            try:
                write(df)
                outcome[name] = None
            except Exception as error:  # noqa: BLE001 - every target gets its turn
                outcome[name] = str(error)
    finally:
        if held:
            df.unpersist()
    failed = {name: error for name, error in outcome.items() if error is not None}
    if failed and (on_partial == "fail" or len(failed) == len(outcome)):
        raise FanoutError(f"targets failed: {failed}")
    return outcome


def ingest_metrics(validated: DataFrame, batch_at: dt.datetime | None = None) -> DataFrame:
    """One metrics row for a validated batch, counted before deduplication."""
    at = F.lit(batch_at) if batch_at else F.current_timestamp()
    accepted = F.col("reason").isNull()
    observation = F.struct("rec.icao24", "rec.observed_at")
    return validated.agg(
        F.count(F.lit(1)).alias("messages_consumed"),
        F.count_if(accepted).alias("rows_written"),
        F.count_if(~accepted).alias("invalid_messages"),
        F.count_distinct(F.when(accepted, observation)).alias("distinct_observations"),
    ).select(at.cast("timestamp").alias("batch_at"), *schemas.INGEST_METRICS.fieldNames()[1:])


def write_ndjson(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON object per line; an absent value is an explicit null."""
    (
        df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
        .write.mode(mode)
        .text(path)
    )


def keyed_messages(df: DataFrame, key: str = "icao24") -> DataFrame:
    """Key and JSON value per row, so that one entity stays in one topic partition."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"),
    )


def write_kafka(df: DataFrame, brokers: str, topic: str, key: str = "icao24") -> None:
    (
        keyed_messages(df, key)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("kafka.enable.idempotence", "true")
        .option("kafka.compression.type", "zstd")
        .option("topic", topic)
        .save()
    )


def write_quarantine(quarantine: DataFrame, path: str, mode: str = "append") -> None:
    """Rejected payloads as they came, with the reason; files are compressed."""
    quarantine.write.mode(mode).option("compression", TEXT_CODEC).json(path)


def materialize(
    df: DataFrame, name: str, order_by: Sequence[str] = (), root: str | None = None, how: str = "table"
) -> DataFrame:
    """Full rebuild of a model table under ``root``, swapped in when complete.

    The rows are written, range-sorted, to a version folder of their own; then a small
    pointer file names it, which every application that calls ``read_model`` sees. The
    version before stays for readers that are still on it; older ones are deleted.
    ``root`` defaults to ``models`` in the shared folder.

    A rebuild first claims its number by a file that only one writer can create, so two
    rebuilds at a time write two versions, and the one that claimed last is read. One
    that two later ones have overtaken may lose its files; nobody would read them.

    ``how="view"`` writes nothing: the model is a temporary view of this session, computed
    whenever it is read. Ordering belongs to readers then.
    """
    if how not in ("table", "view"):
        raise ValueError(f"unknown materialization {how!r}")
    spark = df.sparkSession
    if how == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    home = model_home(spark, name, root)
    versions = _versions(spark, home)
    number = _claimed(spark, home, max(versions, default=-1) + 1)
    rows = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by) if order_by else df
    rows.write.option("compression", "zstd").parquet(f"{home}/version={number}")
    spark.range(1).select(F.lit(number).cast("string")).coalesce(1).write.mode("overwrite").text(
        f"{home}/current/version={number}"
    )
    # The version before stays; a rebuild that runs at the same time is not older than it.
    before = max((n for n in _complete(spark, home) if n < number), default=number - 1)
    for old in (n for n in versions if n < before):
        delete(spark, f"{home}/version={old}")
        delete(spark, f"{home}/current/version={old}")
        delete(spark, f"{home}/claims/version={old}")
    return read_model(spark, name, root)


def _claimed(spark: SparkSession, home: str, number: int) -> int:
    """The first number from ``number`` on that no other writer has."""
    while not claim(spark, f"{home}/claims/version={number}"):
        number += 1
    return number


def model_home(spark: SparkSession, name: str, root: str | None = None) -> str:
    return f"{root or f'{shared_root(spark)}/models'}/{name}"


def _numbered(spark: SparkSession, path: str) -> list[int]:
    return [int(child[8:]) for child in children(spark, path) if child.startswith("version=")]


def _versions(spark: SparkSession, home: str) -> list[int]:
    """Numbers that a rebuild has claimed or written."""
    return sorted({*_numbered(spark, home), *_numbered(spark, f"{home}/claims")})


def _complete(spark: SparkSession, home: str) -> list[int]:
    return [
        n for n in _numbered(spark, f"{home}/current") if "_SUCCESS" in children(spark, f"{home}/current/version={n}")
    ]


def read_model(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """The newest complete version of a model table, from any application."""
    home = model_home(spark, name, root)
    complete = _complete(spark, home)
    if not complete:
        raise FileNotFoundError(f"no complete version of {name} at {home}")
    return spark.read.parquet(f"{home}/version={max(complete)}")


def unexpired(
    df: DataFrame, as_of: dt.datetime, ts: str = "observed_at", days: int = BRONZE_RETENTION_DAYS
) -> DataFrame:
    """Rows no older than ``days`` before ``as_of``; without a zone it is in UTC."""
    return df.where(F.col(ts) >= F.lit(utc(as_of) - dt.timedelta(days=days)))


def apply_retention(
    spark: SparkSession, path: str, as_of: dt.datetime, days: int = BRONZE_RETENTION_DAYS
) -> None:
    """Expire bronze rows in place, in the hourly layout or the table's daily one.

    Whole expired days and hours are removed as folders; only the one the cutoff
    falls into is rewritten. Everything newer is left untouched. ``as_of`` without a
    zone is in UTC.
    """
    cutoff = utc(as_of) - dt.timedelta(days=days)
    day = F.lit(cutoff.date())
    hourly = any(c.startswith("date=") for c in children(spark, path))
    top = "date" if hourly else "day"
    partitions = [T.StructField(top, T.DateType())] + ([T.StructField("hour", T.IntegerType())] if hourly else [])
    stored = spark.read.schema(T.StructType([*schemas.BRONZE.fields, *partitions])).parquet(path)
    keys = [c for c in stored.columns if c not in schemas.BRONZE_COLUMNS]  # with batch, if it is there

    edge = stored.where(F.col(top) == day)
    if hourly:
        edge = edge.where(F.col("hour") == cutoff.hour).withColumn("hour", partition_hour())
    # Settled first: the edge's own files are about to be replaced.
    kept = settle(unexpired(edge, as_of, days=days), "retention")
    (
        kept.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*keys)
        .parquet(path)
    )
    edge_path = f"{path}/{top}={cutoff.date().isoformat()}"
    for name in children(spark, path):
        if name.startswith(f"{top}=") and name < f"{top}={cutoff.date().isoformat()}":
            delete(spark, f"{path}/{name}")
    if hourly:
        for name in children(spark, edge_path):
            if name.startswith("hour=") and int(name[5:]) < cutoff.hour:
                delete(spark, f"{edge_path}/{name}")
        edge_path = f"{edge_path}/hour={cutoff.hour:02d}"
    if kept.isEmpty():
        delete(spark, edge_path)
    elif "batch" in keys:
        live = {r.batch for r in kept.select("batch").distinct().collect()}  # batches of one edge
        for name in children(spark, edge_path):
            if name.startswith("batch=") and int(name[6:]) not in live:
                delete(spark, f"{edge_path}/{name}")
    release(kept)
    spark.catalog.refreshByPath(path)


def expire_metrics(
    spark: SparkSession, path: str, as_of: dt.datetime, days: int = METRICS_RETENTION_DAYS
) -> None:
    """Remove the folders of ingest batches older than ``days`` before ``as_of``."""
    cutoff = utc(as_of) - dt.timedelta(days=days)
    rows = spark.read.schema(schemas.INGEST_METRICS).parquet(path)
    expired = rows.groupBy("batch").agg(F.max("batch_at").alias("last")).where(F.col("last") < F.lit(cutoff))
    for row in expired.collect():  # what expired since the last run, a row per batch
        delete(spark, f"{path}/batch={row.batch}")
    spark.catalog.refreshByPath(path)
