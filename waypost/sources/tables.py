"""Bronze Parquet and reference tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waypost import schemas


def read_bronze(
    spark: SparkSession,
    path: str,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
) -> DataFrame:
    """Bronze rows observed in ``[start, end)``.

    A bound without a zone is in UTC. Spark does not derive partition predicates
    from an ``observed_at`` range, so the ``date`` and ``hour`` bounds of the same
    UTC instants are added here.
    """
    bronze = spark.read.schema(schemas.BRONZE_PARTITIONED).parquet(path)
    date, hour = F.col("date"), F.col("hour")
    if start is not None:
        start = utc(start)
        bronze = bronze.where(F.col("observed_at") >= F.lit(start)).where(
            (date > F.lit(start.date())) | ((date == F.lit(start.date())) & (hour >= start.hour))
        )
    if end is not None:
        end = utc(end)
        bronze = bronze.where(F.col("observed_at") < F.lit(end)).where(
            (date < F.lit(end.date())) | ((date == F.lit(end.date())) & (hour <= end.hour))
        )
    return bronze.select(*schemas.BRONZE_COLUMNS)


def utc(moment: dt.datetime) -> dt.datetime:
    """The instant in UTC; a datetime without a zone is one already."""
    if moment.tzinfo is None:
        return moment.replace(tzinfo=dt.timezone.utc)
    return moment.astimezone(dt.timezone.utc)


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """Reference points from CSV with declared types."""
    return (
        spark.read.schema(schemas.AIRPORTS)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
