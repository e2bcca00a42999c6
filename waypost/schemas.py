"""Declared schemas. Readers always get one of these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

#: A state vector stays JSON text until it is decoded: as an array of strings, numbers
#: and flags could not be told from text.
POLL = T.StructType(
    [
        T.StructField("time", T.LongType()),
        T.StructField("states", T.ArrayType(T.StringType())),
    ]
)

#: One decoded state vector; index in the list = position in the JSON array.
#: ``sensors`` sits at position 12 on the wire and is dropped at decode.
VECTOR_FIELDS = (
    ("icao24", "string", True),
    ("callsign", "string", False),
    ("origin_country", "string", True),
    ("time_position", "bigint", False),
    ("last_contact", "bigint", True),
    ("longitude", "double", False),
    ("latitude", "double", False),
    ("baro_altitude", "double", False),
    ("on_ground", "boolean", True),
    ("velocity", "double", False),
    ("true_track", "double", False),
    ("vertical_rate", "double", False),
    ("sensors", "string", False),
    ("geo_altitude", "double", False),
    ("squawk", "string", False),
    ("spi", "boolean", True),
    ("position_source", "smallint", True),
    ("category", "smallint", False),
)
MIN_VECTOR_FIELDS = 17

BRONZE = T.StructType(
    [
        T.StructField("icao24", T.StringType(), False),
        T.StructField("observed_at", T.TimestampType(), False),
        T.StructField("callsign", T.StringType()),
        T.StructField("origin_country", T.StringType(), False),
        T.StructField("time_position", T.TimestampType()),
        T.StructField("last_contact", T.TimestampType(), False),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("baro_altitude", T.DoubleType()),
        T.StructField("on_ground", T.BooleanType(), False),
        T.StructField("velocity", T.DoubleType()),
        T.StructField("true_track", T.DoubleType()),
        T.StructField("vertical_rate", T.DoubleType()),
        T.StructField("geo_altitude", T.DoubleType()),
        T.StructField("squawk", T.StringType()),
        T.StructField("spi", T.BooleanType(), False),
        T.StructField("position_source", T.ShortType(), False),
        T.StructField("category", T.ShortType()),
        T.StructField("region", T.StringType(), False),
        T.StructField("poll_time", T.TimestampType(), False),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("position_age_seconds", T.IntegerType(), False),
    ]
)
BRONZE_COLUMNS = BRONZE.fieldNames()
EPOCH_COLUMNS = ("observed_at", "time_position", "last_contact", "poll_time", "ingested_at")

#: Wire record: bronze plus the transported-but-not-stored key, times as epoch seconds.
RECORD_COLUMNS = ["icao24", "dedup_key", "observed_at", *BRONZE_COLUMNS[2:]]

BRONZE_PARTITIONED = T.StructType(
    [*BRONZE.fields, T.StructField("date", T.DateType()), T.StructField("hour", T.IntegerType())]
)

INGEST_METRICS = T.StructType(
    [
        T.StructField("batch_at", T.TimestampType()),
        T.StructField("messages_consumed", T.LongType()),
        T.StructField("rows_written", T.LongType()),
        T.StructField("invalid_messages", T.LongType()),
        T.StructField("distinct_observations", T.LongType()),
    ]
)

AIRPORTS = T.StructType(
    [
        T.StructField("icao", T.StringType()),
        T.StructField("iata", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("elevation_m", T.IntegerType()),
    ]
)

REGIONS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("lat_min", T.DoubleType()),
        T.StructField("lon_min", T.DoubleType()),
        T.StructField("lat_max", T.DoubleType()),
        T.StructField("lon_max", T.DoubleType()),
    ]
)
