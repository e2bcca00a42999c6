"""Sources, sinks, decoding and validation over the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waypost import schemas
from waypost.catalog import standin as S
from waypost.catalog.registry import query
from waypost.functions import scalar as X
from waypost.functions.geo import haversine_km
from waypost.operators.boxes import bbox_cost, bbox_filter, bbox_validate
from waypost.operators.validation import field_drift, ratio_verdict, split_valid, validate
from waypost.plans.serving import geojson_bounds, geojson_features, latest_positions
from waypost.sinks import tables as sinks
from waypost.sources import polls as P
from waypost.sources.records import read_ndjson
from waypost.sources.tables import read_airports, read_bronze
from waypost.workspace import fresh_path

VECTOR_COLUMNS = [n for n, _, _ in schemas.VECTOR_FIELDS if n != "sensors"]
_VEC_LIST = ", ".join("raw_callsign AS callsign" if c == "callsign" else c for c in VECTOR_COLUMNS)
_REC_LIST = ", ".join(schemas.RECORD_COLUMNS)
_BRONZE_LIST = ", ".join(schemas.BRONZE_COLUMNS)
VEC, REC = S.VEC_SQL, S.REC_SQL


def rec_sql(body: str) -> str:
    return S.with_sql(body, VEC, REC)


def vec_sql(body: str) -> str:
    return S.with_sql(body, VEC)


# Sources ---------------------------------------------------------------------


@query("src_states_json", vec_sql(f"SELECT poll_time, pos, {_VEC_LIST} FROM vec"))
def src_states_json(spark, sf):
    path = fresh_path(spark, "polls")
    S.poll_documents(spark, sf).select("value").write.text(path)
    vectors, _ = P.decode_vectors(P.read_polls(spark, path, lines=True))
    return vectors.drop("file")


@query("src_ndjson", rec_sql(f"SELECT {_REC_LIST} FROM rec"))
def src_ndjson(spark, sf):
    path = fresh_path(spark, "records")
    S.messages(spark, sf, corrupt=False).select("value").write.text(path)
    wire = ", ".join(
        f"{c} {'BIGINT' if c in schemas.EPOCH_COLUMNS else _type_of(c)}" for c in schemas.RECORD_COLUMNS
    )
    return read_ndjson(spark, path).select(F.from_json("value", wire).alias("r")).select("r.*")


def _type_of(column: str) -> str:
    return "string" if column == "dedup_key" else schemas.BRONZE[column].dataType.simpleString()


WINDOW = (dt.datetime(2024, 1, 10, 6), dt.datetime(2024, 1, 10, 18))
_FROM, _TO = (int(t.replace(tzinfo=dt.timezone.utc).timestamp()) for t in WINDOW)


@query(
    "src_bronze",
    rec_sql(f"SELECT {_BRONZE_LIST} FROM rec WHERE observed_at >= {_FROM} AND observed_at < {_TO}"),
)
def src_bronze(spark, sf):
    path = fresh_path(spark, "bronze")
    sinks.write_bronze(S.bronze(spark, sf), path)
    return read_bronze(spark, path, *WINDOW)


@query(
    "src_seed_csv",
    """SELECT s_name AS icao, 'F' || s_suppkey AS iata, 'Field ' || s_suppkey AS name,
       'NATION_' || s_nationkey AS country, (450 + s_suppkey * 7 % 100) / 10.0 AS latitude,
       (30 + s_suppkey % 100) / 10.0 AS longitude, s_suppkey % 900 AS elevation_m FROM supplier""",
)
def src_seed_csv(spark, sf):
    path = fresh_path(spark, "airports")
    S.airports(spark, sf).write.option("header", True).csv(path)
    return read_airports(spark, path)


# Sinks -----------------------------------------------------------------------


@query(
    "snk_bronze_parquet",
    rec_sql(
        f"""SELECT {_BRONZE_LIST}, strftime(make_timestamp(observed_at * 1000000), '%Y-%m-%d') AS date,
            observed_at // 3600 % 24 AS hour FROM rec"""
    ),
)
def snk_bronze_parquet(spark, sf):
    path = fresh_path(spark, "bronze")
    sinks.write_bronze(S.bronze(spark, sf), path)
    return spark.read.schema(schemas.BRONZE_PARTITIONED).parquet(path)


@query("snk_bronze_table", rec_sql(f"SELECT {_BRONZE_LIST} FROM rec"))
def snk_bronze_table(spark, sf):
    path = fresh_path(spark, "bronze-table")
    sinks.write_bronze_table(S.bronze(spark, sf), path)
    return spark.read.parquet(path).select(*schemas.BRONZE_COLUMNS)


@query(
    "snk_fanout",
    rec_sql(
        """SELECT target, count(*) AS rows, count(DISTINCT icao24) AS aircraft
           FROM rec, (VALUES ('lake'), ('table')) t(target) GROUP BY target"""
    ),
)
def snk_fanout(spark, sf):
    lake, tab = fresh_path(spark, "lake"), fresh_path(spark, "table")
    sinks.write_fanout(
        S.bronze(spark, sf),
        {
            "lake": lambda rows: sinks.write_bronze(rows, lake),
            "table": lambda rows: sinks.write_bronze_table(rows, tab),
        },
    )

    def counted(name: str, path: str) -> DataFrame:
        return spark.read.parquet(path).agg(
            F.lit(name).alias("target"),
            F.count(F.lit(1)).alias("rows"),
            F.count_distinct("icao24").alias("aircraft"),
        )

    return counted("lake", lake).unionByName(counted("table", tab))


@query(
    "snk_ingest_metrics",
    rec_sql(
        f"""SELECT count(*) AS messages_consumed,
            count(*) FILTER (WHERE reason IS NULL) AS rows_written,
            count(*) FILTER (WHERE reason IS NOT NULL) AS invalid_messages,
            count(DISTINCT CASE WHEN reason IS NULL THEN icao24 || '@' || observed_at END)
              AS distinct_observations
            FROM (SELECT *, {S.REASON_SQL} AS reason FROM rec)"""
    ),
)
def snk_ingest_metrics(spark, sf):
    return sinks.ingest_metrics(validate(S.messages(spark, sf))).drop("batch_at")


@query("snk_ndjson", rec_sql(f"SELECT {_REC_LIST} FROM rec"))
def snk_ndjson(spark, sf):
    path = fresh_path(spark, "ndjson")
    wire = S.records(spark, sf)
    sinks.write_ndjson(wire, path)
    return (
        read_ndjson(spark, path).select(F.from_json("value", wire.schema).alias("r")).select("r.*")
    )


@query("snk_kafka", rec_sql(f"SELECT icao24 AS key, {_REC_LIST} FROM rec"))
def snk_kafka(spark, sf):
    wire = S.records(spark, sf)
    return sinks.keyed_messages(wire).select(
        "key", F.from_json("value", wire.schema).alias("r")
    ).select("key", "r.*")


@query(
    "snk_quarantine",
    rec_sql(
        f"""SELECT reason, count(*) AS messages FROM (SELECT {S.REASON_SQL} AS reason FROM rec)
            WHERE reason IS NOT NULL GROUP BY reason"""
    ),
)
def snk_quarantine(spark, sf):
    path = fresh_path(spark, "quarantine")
    _, rejected = split_valid(validate(S.messages(spark, sf)))
    sinks.write_quarantine(rejected, path)
    kept = spark.read.schema("reason string, payload string").json(path)
    return kept.groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


@query("snk_materialize", S.with_sql("SELECT * FROM traffic", VEC, REC, S.SILVER_SQL, S.TRAFFIC_SQL))
def snk_materialize(spark, sf):
    return sinks.materialize(S.traffic(spark, sf), "hourly_traffic", ["traffic_hour", "region"])


@query("snk_materialize_view", S.with_sql("SELECT * FROM traffic", VEC, REC, S.SILVER_SQL, S.TRAFFIC_SQL))
def snk_materialize_view(spark, sf):
    return sinks.materialize(S.traffic(spark, sf), "hourly_traffic_view", how="view")


RETAIN_AS_OF = dt.datetime(2024, 2, 20, 5, 30, tzinfo=dt.timezone.utc)
_CUTOFF = int(RETAIN_AS_OF.timestamp()) - 30 * 86_400


@query("snk_retention", rec_sql(f"SELECT {_BRONZE_LIST} FROM rec WHERE observed_at >= {_CUTOFF}"))
def snk_retention(spark, sf):
    path = fresh_path(spark, "bronze")
    sinks.write_bronze(S.bronze(spark, sf), path)
    sinks.apply_retention(spark, path, RETAIN_AS_OF)
    return read_bronze(spark, path)



DAY = 86_400
LATEST_SQL = f"""
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY observed_at DESC) AS newest
    FROM silver WHERE has_usable_position AND observed_at >= {S.AS_OF_EPOCH - DAY})
  WHERE newest = 1
)"""


@query(
    "snk_geojson",
    S.with_sql(
        "SELECT icao24, longitude, latitude, coalesce(callsign, '') AS callsign,"
        " altitude_m AS altitude, on_ground FROM latest",
        VEC, REC, S.SILVER_SQL, LATEST_SQL,
    ),
)
def snk_geojson(spark, sf):
    features = geojson_features(latest_positions(S.silver(spark, sf), S.AS_OF, DAY))
    shape = (
        "type string, geometry struct<type:string,coordinates:array<double>>, "
        "properties struct<icao24:string,callsign:string,altitude:double,onGround:boolean>"
    )
    f = features.select(F.from_json("feature", shape).alias("f")).select("f.*")
    return f.select(
        "properties.icao24",
        F.get("geometry.coordinates", F.lit(0)).alias("longitude"),
        F.get("geometry.coordinates", F.lit(1)).alias("latitude"),
        "properties.callsign",
        "properties.altitude",
        F.col("properties.onGround").alias("on_ground"),
    )


@query(
    "snk_geojson_bounds",
    S.with_sql(
        "SELECT min(longitude) AS west, min(latitude) AS south, max(longitude) AS east,"
        " max(latitude) AS north FROM latest",
        VEC, REC, S.SILVER_SQL, LATEST_SQL,
    ),
)
def snk_geojson_bounds(spark, sf):
    return geojson_bounds(latest_positions(S.silver(spark, sf), S.AS_OF, DAY))


# Decoding and expressions ------------------------------------------------------


@query("decode_positional", vec_sql(f"SELECT file, poll_time, pos, {_VEC_LIST} FROM vec"))
def decode_positional(spark, sf):
    vectors, _ = P.decode_vectors(S.polls(spark, sf))
    return vectors


@query(
    "decode_quarantine",
    vec_sql(
        """SELECT reason, count(*) AS vectors FROM (
             SELECT CASE WHEN event_id % 19 = 0 THEN '4 fields'
               WHEN event_id % 23 = 0 THEN 'last_contact: not a bigint'
               WHEN event_id % 29 = 0 THEN 'icao24: not a string'
               WHEN event_id % 31 = 0 THEN 'spi: not a boolean'
               WHEN event_id % 37 = 0 THEN 'spi: not a boolean'
               WHEN event_id % 41 = 0 THEN 'time_position: not a bigint' END AS reason FROM vec)
           WHERE reason IS NOT NULL GROUP BY reason"""
    ),
)
def decode_quarantine(spark, sf):
    """Elements of a wrong JSON type, though their text would read as the right one."""
    event = F.regexp_extract("file", "([0-9]+)", 1).cast("bigint")
    field = r"([^,]*)"
    first = rf"^\[{','.join([field] * 5)},"
    spi = r"(true|false),(\d+),([^,]*)\]$"
    damaged = P.with_fields(
        S.polls(spark, sf)
        .drop("v")
        .withColumn(
            "raw",
            F.when(event % 19 == 0, F.regexp_replace("raw", first + ".*$", "[$1,$2,$3,$4]"))
            .when(event % 23 == 0, F.regexp_replace("raw", first, '[$1,$2,$3,$4,"$5",'))
            .when(event % 29 == 0, F.regexp_replace("raw", first, "[31,$2,$3,$4,$5,"))
            .when(event % 31 == 0, F.regexp_replace("raw", spi, "1,$2,$3]"))
            .when(event % 37 == 0, F.regexp_replace("raw", spi, '"$1",$2,$3]'))
            .when(event % 41 == 0, F.regexp_replace("raw", first, "[$1,$2,$3,7.25,$5,"))
            .otherwise(F.col("raw")),
        )
    )
    _, quarantined = P.decode_vectors(damaged)
    return quarantined.groupBy("reason").agg(F.count(F.lit(1)).alias("vectors"))


@query(
    "trim_callsign",
    vec_sql("SELECT file, pos, nullif(trim(raw_callsign), '') AS callsign FROM vec"),
)
def trim_callsign(spark, sf):
    return S.vectors(spark, sf).select("file", "pos", X.trim_callsign("callsign").alias("callsign"))


@query(
    "observed_at",
    vec_sql("SELECT file, pos, coalesce(time_position, last_contact) AS observed_at FROM vec"),
)
def observed_at(spark, sf):
    return S.vectors(spark, sf).select(
        "file", "pos", X.observed_at("time_position", "last_contact").alias("observed_at")
    )


@query("dedup_key", rec_sql("SELECT event_id, pos, dedup_key FROM rec"))
def dedup_key(spark, sf):
    return S.vectors(spark, sf).select(
        "event_id", "pos", X.dedup_key("icao24", "time_position", "last_contact").alias("dedup_key")
    )


@query("position_age", rec_sql("SELECT event_id, pos, position_age_seconds FROM rec"))
def position_age(spark, sf):
    return S.vectors(spark, sf).select(
        "event_id", "pos", X.position_age("time_position", "last_contact").alias("position_age_seconds")
    )


@query("add_provenance", rec_sql(f"SELECT {_REC_LIST} FROM rec"))
def add_provenance(spark, sf):
    return S.records(spark, sf)


@query(
    "has_position",
    vec_sql(
        "SELECT (latitude IS NOT NULL AND longitude IS NOT NULL) AS has_position, count(*) AS n"
        " FROM vec GROUP BY 1"
    ),
)
def has_position(spark, sf):
    return S.vectors(spark, sf).groupBy(X.has_position().alias("has_position")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "bbox_filter",
    vec_sql(
        "SELECT file, pos, latitude, longitude FROM vec WHERE latitude IS NULL OR longitude IS NULL"
        " OR (latitude BETWEEN 46.5 AND 50.1 AND longitude BETWEEN 4 AND 9.3)"
    ),
)
def bbox_filter_query(spark, sf):
    return bbox_filter(S.vectors(spark, sf), 46.5, 4.0, 50.1, 9.3).select(
        "file", "pos", "latitude", "longitude"
    )


@query(
    "time_shift",
    vec_sql(
        f"""SELECT file, pos, poll_time + d AS poll_time, last_contact + d AS last_contact,
            time_position + d AS time_position
            FROM vec, (SELECT {S.AS_OF_EPOCH} - arg_min(poll_time, file) AS d FROM vec)"""
    ),
)
def time_shift(spark, sf):
    shifted = P.time_shift(S.vectors(spark, sf), S.AS_OF_EPOCH)
    return shifted.select("file", "pos", "poll_time", "last_contact", "time_position")


@query(
    "epoch_to_ts",
    rec_sql(
        "SELECT event_id, pos, strftime(make_timestamp(observed_at * 1000000), '%Y-%m-%d %H:%M:%S')"
        " AS observed_at FROM rec"
    ),
)
def epoch_to_ts(spark, sf):
    return S.records(spark, sf, keep=("event_id", "pos")).select(
        "event_id", "pos", X.epoch_to_ts("observed_at").cast("string").alias("observed_at")
    )


@query(
    "best_altitude",
    rec_sql("SELECT event_id, pos, coalesce(geo_altitude, baro_altitude) AS altitude_m FROM rec"),
)
def best_altitude(spark, sf):
    return S.vectors(spark, sf).select("event_id", "pos", X.best_altitude().alias("altitude_m"))


@query(
    "usable_position",
    rec_sql(
        "SELECT event_id, pos, (latitude IS NOT NULL AND longitude IS NOT NULL AND"
        " position_age_seconds <= 60) AS usable FROM rec"
    ),
)
def usable_position(spark, sf):
    return S.records(spark, sf, keep=("event_id", "pos")).select(
        "event_id", "pos", X.usable_position().alias("usable")
    )


@query(
    "flight_phase",
    vec_sql(
        """SELECT file, pos, CASE WHEN on_ground THEN 'ground' WHEN vertical_rate IS NULL THEN 'unknown'
           WHEN vertical_rate > 1.5 THEN 'climb' WHEN vertical_rate < -1.5 THEN 'descent'
           ELSE 'cruise' END AS phase FROM vec"""
    ),
)
def flight_phase(spark, sf):
    return S.vectors(spark, sf).select("file", "pos", X.flight_phase().alias("phase"))


@query(
    "haversine_km",
    vec_sql(
        "SELECT file, pos, round("
        + S.haversine_sql("latitude", "longitude", "(40 + event_id % 90)", "(event_id % 360 - 180)")
        + ", 6) AS km FROM vec"
    ),
)
def haversine_query(spark, sf):
    far_lat, far_lon = F.col("event_id") % 90 + 40, F.col("event_id") % 360 - 180
    return S.vectors(spark, sf).select(
        "file", "pos", F.round(haversine_km("latitude", "longitude", far_lat, far_lon), 6).alias("km")
    )


@query(
    "unit_convert",
    rec_sql(
        """SELECT event_id, pos, round(velocity * 1.94384e0) AS knots,
           ((position_age_seconds * 10 + 30) // 60) / 10.0 AS minutes,
           geo_altitude / 1000e0 AS altitude_km FROM rec"""
    ),
)
def unit_convert(spark, sf):
    return S.records(spark, sf, keep=("event_id", "pos")).select(
        "event_id", "pos", X.to_knots("velocity").alias("knots"),
        X.to_minutes("position_age_seconds").alias("minutes"),
        X.metres_to_km("geo_altitude").alias("altitude_km"),
    )


@query(
    "partition_cols",
    rec_sql(
        """SELECT strftime(make_timestamp(observed_at * 1000000), '%Y-%m-%d') AS date,
           strftime(make_timestamp(observed_at * 1000000), '%H') AS hour, count(*) AS rows
           FROM rec GROUP BY 1, 2"""
    ),
)
def partition_cols(spark, sf):
    return S.bronze(spark, sf).groupBy(
        X.partition_date().alias("date"), X.partition_hour().alias("hour")
    ).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "hour_bucket",
    rec_sql("SELECT observed_at // 3600 * 3600 AS hour, count(*) AS rows FROM rec GROUP BY 1"),
)
def hour_bucket(spark, sf):
    return S.bronze(spark, sf).groupBy(X.hour_bucket().alias("hour")).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "safe_ratio",
    """SELECT o_custkey AS custkey, count(*) AS orders,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS finished,
         CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'F') > 0 THEN
           (20 * count(*) + count(*) FILTER (WHERE o_orderstatus = 'F'))
             // (2 * count(*) FILTER (WHERE o_orderstatus = 'F')) / 10.0 END AS orders_per_finished,
         (2000 * count(*) FILTER (WHERE o_orderstatus = 'F') + count(*)) // (2 * count(*)) / 10.0
           AS finished_pct
       FROM orders GROUP BY 1""",
)
def safe_ratio(spark, sf):
    per_customer = S.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderstatus") == "F").alias("finished")
    )
    return per_customer.withColumns(
        {
            "orders_per_finished": X.safe_ratio("orders", "finished"),
            "finished_pct": X.safe_percent("finished", "orders"),
        }
    )


@query(
    "empty_to_null",
    vec_sql("SELECT file, pos, nullif(CASE WHEN spi THEN '' ELSE squawk END, '') AS squawk FROM vec"),
)
def empty_to_null(spark, sf):
    return S.vectors(spark, sf).select(
        "file", "pos",
        X.empty_to_null(F.when(F.col("spi"), F.lit("")).otherwise(F.col("squawk"))).alias("squawk"),
    )


@query("flight_id", "SELECT l_orderkey || '-' || l_linenumber AS flight_id FROM lineitem")
def flight_id(spark, sf):
    return S.table(spark, sf, "lineitem").select(
        X.flight_id(F.col("l_orderkey").cast("string"), "l_linenumber").alias("flight_id")
    )


_BOX_LIST = "name, lat_min, lon_min, lat_max, lon_max"
# Boxes from customers: all price tiers, their exact limits, and every kind of invalid box.
_CUSTOMER_BOXES = """
cb AS (
  SELECT CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_name END AS name,
    CASE WHEN c_custkey % 13 = 0 THEN 0e0 ELSE CAST(c_custkey % 120 - 95 AS DOUBLE) END AS lat_min,
    CASE WHEN c_custkey % 13 = 0 THEN 0e0 ELSE CAST(c_custkey % 370 - 185 AS DOUBLE) END AS lon_min,
    CASE WHEN c_custkey % 13 = 0 THEN 0e0
         ELSE CAST(c_custkey % 120 - 95 + c_custkey % 23 AS DOUBLE) END AS lat_max,
    CASE WHEN c_custkey % 13 = 0 THEN 0e0
         ELSE CAST(c_custkey % 370 - 185 + c_custkey % 29 - 1 AS DOUBLE) END AS lon_max
  FROM customer
)"""


def _customer_boxes(spark, sf):
    n = F.col("c_custkey")

    def corner(expr):
        return F.when(n % 13 == 0, F.lit(0.0)).otherwise(expr.cast("double"))

    return S.table(spark, sf, "customer").select(
        F.when(n % 11 == 0, F.lit("")).otherwise(F.col("c_name")).alias("name"),
        corner(n % 120 - 95).alias("lat_min"),
        corner(n % 370 - 185).alias("lon_min"),
        corner(n % 120 - 95 + n % 23).alias("lat_max"),
        corner(n % 370 - 185 + n % 29 - 1).alias("lon_max"),
    )


@query(
    "bbox_area_cost",
    S.with_sql(
        f"""SELECT {_BOX_LIST}, area_sq_deg, CASE WHEN globe THEN 4 WHEN area_sq_deg <= 25 THEN 1
              WHEN area_sq_deg <= 100 THEN 2 WHEN area_sq_deg <= 400 THEN 3 ELSE 4 END AS cost
            FROM (SELECT *, (lat_min = 0 AND lon_min = 0 AND lat_max = 0 AND lon_max = 0) AS globe,
                    CASE WHEN lat_min = 0 AND lon_min = 0 AND lat_max = 0 AND lon_max = 0 THEN 64800e0
                    ELSE (lat_max - lat_min) * (lon_max - lon_min) END AS area_sq_deg FROM cb)""",
        _CUSTOMER_BOXES,
    ),
)
def bbox_area_cost(spark, sf):
    return bbox_cost(_customer_boxes(spark, sf))


@query(
    "bbox_validate",
    S.with_sql(
        f"""SELECT {_BOX_LIST}, CASE WHEN name = '' THEN 'unnamed'
              WHEN lat_min = 0 AND lon_min = 0 AND lat_max = 0 AND lon_max = 0 THEN NULL
              WHEN lat_min >= lat_max OR lon_min >= lon_max THEN 'inverted'
              WHEN lat_min < -90 OR lat_max > 90 THEN 'latitude out of range'
              WHEN lon_min < -180 OR lon_max > 180 THEN 'longitude out of range' END AS reason
            FROM cb""",
        _CUSTOMER_BOXES,
    ),
)
def bbox_validate_query(spark, sf):
    return bbox_validate(_customer_boxes(spark, sf))


# Validation ----------------------------------------------------------------------

FAMILIES = {
    "val_json": ["json: unparseable"],
    "val_object": ["record: not an object"],
    "val_text": [
        "icao24: required", "icao24: empty", "icao24: not a string", "callsign: not a string",
        "region: required", "origin_country: required",
    ],
    "val_epoch": [
        "observed_at: required", "observed_at: implausible epoch", "observed_at: not an integer",
        "poll_time: not an integer", "time_position: not an integer",
    ],
    "val_number": ["velocity: not a number", "baro_altitude: not a number",
                   "position_age_seconds: not a number"],
    "val_flag": ["on_ground: not a boolean", "spi: not a boolean"],
    "val_range": [
        "latitude: out of range", "longitude: out of range", "category: out of range",
        "category: not an integer", "position_source: out of range",
        "position_source: not an integer",
    ],
}


def _family(name: str, reasons: list[str]) -> None:
    listed = ", ".join(f"'{r}'" for r in reasons)

    @query(
        name,
        rec_sql(
            f"""SELECT event_id, pos, reason FROM (SELECT event_id, pos, {S.REASON_SQL} AS reason FROM rec)
                WHERE reason IN ({listed})"""
        ),
    )
    def rejected(spark, sf):
        judged = validate(S.messages(spark, sf))
        return judged.where(F.col("reason").isin(reasons)).select("event_id", "pos", "reason")


for _name, _reasons in FAMILIES.items():
    _family(_name, _reasons)


@query(
    "val_records",
    rec_sql(
        f"""SELECT {_BRONZE_LIST.replace(' velocity,', " CASE WHEN event_id % 41 = 25 THEN 0e0 ELSE velocity END AS velocity,")}
            FROM rec WHERE {S.REASON_SQL} IS NULL"""
    ),
)
def val_records(spark, sf):
    accepted, _ = split_valid(validate(S.messages(spark, sf)))
    return accepted


@query(
    "val_drift",
    rec_sql(
        """SELECT 'region' AS field, 'missing' AS drift, count(*) AS messages FROM rec
             WHERE event_id % 7 = 3
           UNION ALL SELECT 'speed', 'unexpected', count(*) FROM rec WHERE event_id % 7 = 5"""
    ),
)
def val_drift(spark, sf):
    slot = F.col("event_id") % 7
    drifting = S.messages(spark, sf, corrupt=False).withColumn(
        "value",
        F.when(slot == 3, F.regexp_replace("value", '"region":"[^"]*",', ""))
        .when(slot == 5, F.regexp_replace("value", r"^\{", '{"speed":1,'))
        .otherwise(F.col("value")),
    )
    return field_drift(drifting)


@query(
    "val_ratio_guard",
    rec_sql(
        f"""SELECT count(*) AS messages, count(reason) AS invalid,
              count(reason) / count(*) AS invalid_ratio,
              (count(*) >= 100 AND count(reason) / count(*) > 0.05) AS stop,
              (SELECT string_agg(reason, ',' ORDER BY reason) FROM (
                 SELECT DISTINCT {S.REASON_SQL} AS reason FROM rec ORDER BY reason NULLS LAST LIMIT 5))
                AS samples
            FROM (SELECT {S.REASON_SQL} AS reason FROM rec)"""
    ),
)
def val_ratio_guard(spark, sf):
    return ratio_verdict(validate(S.messages(spark, sf)))
