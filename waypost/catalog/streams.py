"""Streaming jobs run to completion over the driver's tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from waypost import schemas
from waypost.catalog import standin as S
from waypost.catalog.records import _BRONZE_LIST, DAY, LATEST_SQL, rec_sql
from waypost.catalog.registry import query
from waypost.catalog.relational import _KEEP, session_sql, silver_sql
from waypost.plans.flights import SESSION_COLUMNS
from waypost.plans.partials import headline, read_partials
from waypost.sinks.tables import TEXT_CODEC, write_bronze_table
from waypost.sources.records import stream_ndjson
from waypost.sources.tables import read_bronze
from waypost.streaming.ingest import IngestPaths, start_bronze
from waypost.streaming.live import read_live, start_live
from waypost.streaming.marts import read_flights, read_traffic, start_marts
from waypost.streaming.sessions import read_sessions, start_sessions
from waypost.streaming.silver import read_latest, start_silver, stream_bronze
from waypost.workspace import delete, fresh_path, settle, sweep

VEC, REC, SILVER = S.VEC_SQL, S.REC_SQL, S.SILVER_SQL


#: Most events whose messages are landed in one file; a compressed file is read by one task.
FILE_EVENTS = 25_000


def _ingest(spark, sf, corrupt: bool, files: int, per_trigger: int | None) -> IngestPaths:
    """Land the messages as text files, then stream them into bronze.

    There are ``files`` times as many files, and ``per_trigger`` times as many to a batch,
    as keep a file small however many events there are; the batches stay as many.
    """
    landing, root = fresh_path(spark, "landing"), fresh_path(spark, "ingest")
    times = -(-S.table(spark, sf, "events").count() // (files * FILE_EVENTS)) or 1
    files, per_trigger = files * times, per_trigger and per_trigger * times
    messages = S.messages(spark, sf, corrupt).select("value").repartition(files)
    messages.write.option("compression", TEXT_CODEC).text(landing)
    sweep(spark)
    paths = IngestPaths(
        bronze=f"{root}/bronze", quarantine=f"{root}/quarantine", metrics=f"{root}/metrics",
        checkpoint=f"{root}/checkpoint", partials=f"{root}/partials",
    )
    source = stream_ndjson(spark, landing, per_trigger)
    # The stand-in breaks most messages on purpose.
    job = start_bronze(source, paths, bounded=True, max_invalid_ratio=1.0)
    job.awaitTermination()
    delete(spark, landing)
    return paths


@query(
    "str_bronze",
    rec_sql(
        f"""SELECT {_BRONZE_LIST.replace(' velocity,', " CASE WHEN event_id % 41 = 25 THEN 0e0 ELSE velocity END AS velocity,")}
            FROM rec WHERE {S.REASON_SQL} IS NULL"""
    ),
)
def str_bronze(spark, sf):
    return read_bronze(spark, _ingest(spark, sf, True, 4, 2).bronze)


@query(
    "str_bounded",
    rec_sql(
        f"""SELECT count(*) AS messages_consumed, count(*) FILTER (WHERE reason IS NULL) AS rows_written,
              count(reason) AS invalid_messages, 1 AS batches
            FROM (SELECT {S.REASON_SQL} AS reason FROM rec)"""
    ),
)
def str_bounded(spark, sf):
    paths = _ingest(spark, sf, True, 2, None)
    return spark.read.schema(schemas.INGEST_METRICS).parquet(paths.metrics).agg(
        *[F.sum(c).alias(c) for c in ("messages_consumed", "rows_written", "invalid_messages")],
        F.count(F.lit(1)).alias("batches"),
    )


@query(
    "str_headline",
    rec_sql(
        f"""SELECT count(*) AS raw_rows, count(DISTINCT icao24 || '@' || observed_at) AS distinct_observations,
              count(DISTINCT icao24) AS distinct_aircraft, max(observed_at) AS latest_observation,
              string_agg(DISTINCT region, ',' ORDER BY region) AS regions
            FROM rec WHERE {S.REASON_SQL} IS NULL"""
    ),
)
def str_headline(spark, sf):
    """From the counts that each of several batches left; copies meet across batches."""
    paths = _ingest(spark, sf, True, 4, 1)
    return headline(read_partials(spark, paths.partials))


@query(
    "str_late",
    rec_sql(
        """SELECT strftime(make_timestamp(observed_at * 1000000), '%Y-%m-%d') AS date,
             observed_at // 3600 % 24 AS hour, count(*) AS rows,
             count(*) FILTER (WHERE poll_time // 3600 > observed_at // 3600) AS arrived_later
           FROM rec GROUP BY 1, 2"""
    ),
)
def str_late(spark, sf):
    bronze = _ingest(spark, sf, False, 2, None).bronze
    late = F.date_trunc("hour", "poll_time") > F.date_trunc("hour", "observed_at")
    return (
        spark.read.schema(schemas.BRONZE_PARTITIONED)
        .parquet(bronze)
        .groupBy("date", "hour")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if(late).alias("arrived_later"))
    )


def _bronze_stream(spark, sf):
    """Bronze landed in two appends, so that copies meet in different micro-batches."""
    path = fresh_path(spark, "bronze")
    rows = S.bronze(spark, sf)
    second_copy = F.unix_seconds("ingested_at") - F.unix_seconds("poll_time") == 60
    write_bronze_table(rows.where(second_copy), path)
    write_bronze_table(rows.where(~second_copy), path)
    return stream_bronze(spark, path, max_files_per_trigger=50)


@query("str_dedup", silver_sql(f"SELECT {_KEEP} FROM ranked WHERE rn = 1"))
def str_dedup(spark, sf):
    path = fresh_path(spark, "silver")
    start_silver(
        _bronze_stream(spark, sf), f"{path}/table", f"{path}/checkpoint"
    ).awaitTermination()
    return read_latest(spark, f"{path}/table")


@query("str_sessions", silver_sql(f"SELECT {', '.join(SESSION_COLUMNS)} FROM sess", S.sessions_sql()))
def str_sessions(spark, sf):
    """Three runs on one checkpoint; the history lands out of order, copies apart from each other."""
    root = fresh_path(spark, "sessions")
    rows = settle(S.bronze(spark, sf), "bronze")
    day = F.dayofmonth("observed_at")
    part = F.when(day > 20, 0).when(day % 3 == 0, 1)
    parts = rows.withColumn("part", part.otherwise(2))
    for n in range(3):
        write_bronze_table(parts.where(F.col("part") == n), f"{root}/bronze")
        arrived = stream_bronze(spark, f"{root}/bronze")
        start_sessions(arrived, f"{root}/out", f"{root}/checkpoint", S.DAY_GAP).awaitTermination()
    return read_sessions(spark, f"{root}/out")


#: Where an application has run the marts' stream over a folder of tables.
_MARTS: dict[tuple[str, str], str] = {}


def _marts(spark, sf) -> str:
    """The history in three runs, out of order; the second and third are late in part."""
    key = (spark.sparkContext.applicationId, sf)
    if key in _MARTS:
        return _MARTS[key]
    root = fresh_path(spark, "marts")
    day = F.dayofmonth("observed_at")
    part = F.when(day > 20, 0).when(day % 3 == 0, 1).otherwise(2)
    parts = settle(S.bronze(spark, sf), "bronze").withColumn("part", part)
    airports = settle(S.airports(spark, sf), "airports")
    for n in range(3):
        write_bronze_table(parts.where(F.col("part") == n), f"{root}/bronze")
        arrived = stream_bronze(spark, f"{root}/bronze")
        start_marts(arrived, airports, f"{root}/out", f"{root}/checkpoint", S.DAY_GAP).awaitTermination()
    _MARTS[key] = f"{root}/out"
    return _MARTS[key]


@query("str_late_flights", session_sql("SELECT * FROM flights", S.flights_sql()))
def str_late_flights(spark, sf):
    return read_flights(spark, _marts(spark, sf))


@query("str_late_traffic", silver_sql("SELECT * FROM traffic", S.TRAFFIC_SQL))
def str_late_traffic(spark, sf):
    return read_traffic(spark, _marts(spark, sf))


@query(
    "str_live",
    S.with_sql(
        """SELECT icao24, callsign, origin_country, latitude, longitude, altitude_m,
             round(velocity * 1.94384e0) AS velocity_knots, true_track, on_ground, observed_at,
             position_age_seconds FROM latest""",
        VEC, REC, SILVER, LATEST_SQL,
    ),
)
def str_live(spark, sf):
    path = fresh_path(spark, "live")
    # A copy of an observation may come with any later batch here, so all are kept.
    job = start_live(_bronze_stream(spark, sf), f"{path}/out", f"{path}/checkpoint", keep_s=DAY)
    job.awaitTermination()
    return read_live(spark, f"{path}/out", S.AS_OF, DAY)
