"""Flights and hourly traffic rebuilt where a batch changed them, late rows included.

The hours of a batch's observations are the only rows of traffic that can change; they
are computed anew from silver and replace their folders. Of flights, those of the batch's
aircraft can change from the session on that its first new row continued: they are
computed anew from the published sessions and supersede what earlier batches wrote of
them. Nothing else is read or written.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from waypost.params import Params
from waypost.plans.flights import SESSION_COLUMNS, flights
from waypost.plans.silver import positioned
from waypost.plans.traffic import hourly_traffic
from waypost.streaming.runs import merge_runs, read_runs, write_run
from waypost.streaming.sessions import MARK, number_batch, published, standing, undominated
from waypost.streaming.silver import HOUR, read_hours
from waypost.workspace import children, delete

#: What a mark supersedes flights from.
_START = "from_session"


def rebuild_traffic(spark: SparkSession, path: str, hours: DataFrame, batch_id: int, params: Params = Params()) -> None:
    """Replace the folders of some hours (``date`` and ``hour``) of ``traffic`` from silver."""
    silver = positioned(read_hours(spark, f"{path}/silver", hours, before=batch_id + 1), params)
    at = F.col("traffic_hour")
    rows = hourly_traffic(silver, params).withColumns(
        {"date": F.date_format(at, "yyyy-MM-dd"), "hour": F.date_format(at, "HH")}
    )
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        (
            # A row per hour and region: few files. The rebalance shuffles the finished rows;
            # a coalesce would compute all of them in one task.
            rows.hint("rebalance", *HOUR)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*HOUR)
            .parquet(f"{path}/traffic")
        )
        named = hours.select(F.col("date").cast("string").alias("date"), F.format_string("%02d", "hour").alias("hour"))
        empty = named.distinct().join(rows.select(*HOUR).distinct(), HOUR, "left_anti")
        for hour in empty.collect():  # hours whose last positioned row went
            delete(spark, f"{path}/traffic/date={hour.date}/hour={hour.hour}")
    finally:
        rows.unpersist()


def rebuild_flights(
    spark: SparkSession, path: str, changed: DataFrame, airports: DataFrame, batch_id: int, params: Params = Params()
) -> None:
    """Compute the flights of ``changed`` (a batch's marks) anew from their first changed session on."""
    start = F.coalesce("from_session", F.lit(0).cast("bigint"))
    marks = changed.withColumn("from_session", start)
    rows = published(spark, path, batch_id + 1, changed).join(marks.select("icao24", "from_session"), "icao24")
    fact = flights(rows.where("session_seq >= from_session").select(*SESSION_COLUMNS), airports, params)
    write_run(fact.withColumn("batch", F.lit(batch_id).cast("bigint")), f"{path}/flights", batch_id, batch_id)
    write_run(marks.coalesce(1), f"{path}/flight-marks", batch_id, batch_id)
    _merge(spark, path, batch_id)


def _stored(spark: SparkSession, path: str) -> T.StructType:
    """The columns flights were written with; runs differ in none."""
    first = next(name for name in sorted(children(spark, f"{path}/flights")) if name.startswith("run="))
    return spark.read.parquet(f"{path}/flights/{first}").schema


def _standing_flights(rows: DataFrame, marks: DataFrame) -> DataFrame:
    numbered = rows.withColumn("session_seq", F.substring_index("flight_id", "-", -1).cast("bigint"))
    return standing(numbered, undominated(marks, _START), _START, "session_seq").drop("session_seq")


def _merge(spark: SparkSession, path: str, batch_id: int) -> None:
    marks = read_runs(spark, f"{path}/flight-marks", MARK, before=batch_id + 1)
    merge_runs(spark, f"{path}/flights", _stored(spark, path), batch_id, lambda rows: _standing_flights(rows, marks))
    merge_runs(spark, f"{path}/flight-marks", MARK, batch_id, lambda m: undominated(m, _START), whole=True)


def start_marts(
    bronze: DataFrame,
    airports: DataFrame,
    path: str,
    checkpoint: str,
    params: Params = Params(),
    bounded: bool = True,
    every: str = "1 hour",
) -> StreamingQuery:
    """Keep silver, sessions, ``flights`` and ``traffic`` under ``path`` up to date; see ``read_flights``."""

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        arrived = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            changed = number_batch(arrived, path, batch_id, params)
            hours = arrived.select(F.to_date("observed_at").alias("date"), F.hour("observed_at").alias("hour")).distinct()
            rebuild_traffic(spark, path, hours, batch_id, params)
            rebuild_flights(spark, path, changed, airports, batch_id, params)
        finally:
            arrived.unpersist()

    trigger = {"availableNow": True} if bounded else {"processingTime": every}
    return (
        bronze.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_flights(spark: SparkSession, path: str) -> DataFrame:
    """The flight fact as it stands."""
    rows = read_runs(spark, f"{path}/flights", _stored(spark, path))
    marks = read_runs(spark, f"{path}/flight-marks", MARK)
    return _standing_flights(rows, marks).drop("batch")


def read_traffic(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/traffic").drop(*HOUR)
