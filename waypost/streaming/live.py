"""Latest usable position per aircraft, from a stateful aggregate over the stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from waypost import schemas
from waypost.operators.dedup import latest_per_key
from waypost.params import Params
from waypost.plans.serving import latest_positions
from waypost.plans.silver import positioned
from waypost.streaming.runs import merge_runs, read_runs, write_run
from waypost.streaming.silver import KEYS, TIE_BREAKERS, VERSION
from waypost.workspace import children

#: Seconds of observations that are kept, back from the newest one.
KEEP_SECONDS = 900

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_PUBLISHED = T.StructType([*schemas.BRONZE.fields, T.StructField("batch", T.LongType())])


def latest_copies(bronze: DataFrame, keep_s: int = KEEP_SECONDS) -> DataFrame:
    """A stream of each observation's latest copy; its state forgets those older than ``keep_s`` seconds."""
    rest = [c for c in schemas.BRONZE_COLUMNS if c not in (*KEYS, VERSION, *TIE_BREAKERS)]
    best = F.max(F.struct(VERSION, *TIE_BREAKERS, *rest)).alias("best")
    watched = bronze.select(*schemas.BRONZE_COLUMNS).withWatermark("observed_at", f"{keep_s} seconds")
    return watched.groupBy(*KEYS).agg(best).select(*KEYS, "best.*").select(*schemas.BRONZE_COLUMNS)


def start_live(
    bronze: DataFrame, path: str, checkpoint: str, bounded: bool = True, keep_s: int = KEEP_SECONDS
) -> StreamingQuery:
    """Keep the latest copy of every observation of the last ``keep_s`` seconds.

    Whether a fix is usable is judged on its latest copy, so the state is keyed by
    aircraft and instant; a batch publishes the observations it changed, and
    ``read_live`` takes the newest usable one of each aircraft. State is on RocksDB and
    forgets what the watermark passes. What was published is merged every so many
    batches, without what is older than is kept.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        write_run(batch.withColumn("batch", F.lit(batch_id).cast("bigint")), path, batch_id, batch_id)

        def recent(rows: DataFrame) -> DataFrame:
            newest = rows.agg(F.max("observed_at")).scalar()
            latest = latest_per_key(rows, KEYS, ["batch"])
            return latest.where(F.col("observed_at") >= newest - F.make_interval(secs=F.lit(keep_s)))

        merge_runs(spark, path, _PUBLISHED, batch_id, recent, whole=True)

    spark = bronze.sparkSession
    before = spark.conf.get(_PROVIDER)
    trigger = {"availableNow": True} if bounded else {"processingTime": "10 seconds"}
    spark.conf.set(_PROVIDER, _ROCKSDB)  # the query takes a copy of the session's settings
    try:
        return (
            latest_copies(bronze, keep_s)
            .writeStream.outputMode("update")
            .foreachBatch(publish)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )
    finally:
        spark.conf.set(_PROVIDER, before)


def read_live(
    spark: SparkSession,
    path: str,
    as_of: dt.datetime | None = None,
    max_age_s: int = KEEP_SECONDS,
    params: Params = Params(),
) -> DataFrame:
    """What ``latest_positions`` gives over silver, for ages up to the seconds that are kept.

    ``as_of`` is not before the newest observation.
    """
    if not children(spark, path):
        raise FileNotFoundError(f"nothing published at {path}")
    latest = latest_per_key(read_runs(spark, path, _PUBLISHED), KEYS, ["batch"]).drop("batch")
    return latest_positions(positioned(latest, params), as_of, max_age_s)
