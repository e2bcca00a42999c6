"""Record streams as raw text: newline-delimited files and Kafka topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, unparsed, so that a rejected line can be kept as it came."""
    return spark.read.text(path)


def stream_ndjson(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def stream_kafka(
    spark: SparkSession,
    brokers: str,
    topic: str,
    group_id: str | None = None,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Topic subscription; offsets live in the query's checkpoint and advance after a write."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "true")
    )
    if group_id:
        reader = reader.option("groupIdPrefix", group_id)
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"))
