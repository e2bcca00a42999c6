"""Sessions numbered as observations arrive, late rows included.

A micro-batch of bronze is folded into silver first. Aircraft that only moved on are
numbered from the state they were left in; what they need of silver lies in the hours of
the batch. Aircraft that got a row at or before the last one numbered (a late row, or
another copy of an observation) are numbered anew from that row on: the rows after it,
and the state before it, come from the published sessions in their buckets, so their
history in silver is not read again. A mark with the aircraft, the instant and the batch
says which published rows this supersedes.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from waypost import schemas
from waypost.functions.scalar import flight_id, flight_phase
from waypost.operators.dedup import latest_per_key
from waypost.operators.scans import sessionize
from waypost.params import Params
from waypost.plans.flights import SESSION_COLUMNS
from waypost.plans.silver import positioned
from waypost.streaming.runs import merge_runs, read_runs, write_run
from waypost.streaming.silver import merge_latest, read_hours

#: Folders that sessions are dealt to by aircraft.
BUCKETS = 32

#: State of an aircraft; without a ``last_ts`` it has no positioned row.
STATE = T.StructType(
    [
        T.StructField("icao24", T.StringType()),
        T.StructField("last_ts", T.TimestampType()),
        T.StructField("last_state", T.BooleanType()),
        T.StructField("last_seq", T.LongType()),
        T.StructField("last_session", T.LongType()),
    ]
)
_STATES = T.StructType([*STATE.fields, T.StructField("batch", T.LongType())])

#: The aircraft of a batch. Where one is late, its rows of earlier batches from ``since`` on
#: are superseded. Sessions before ``from_session`` are as they were.
MARK = T.StructType(
    [
        T.StructField("icao24", T.StringType()),
        T.StructField("since", T.TimestampType()),
        T.StructField("from_session", T.LongType()),
        T.StructField("late", T.BooleanType()),
        T.StructField("batch", T.LongType()),
    ]
)

#: What sessions take from silver.
_INPUT = [
    "icao24", "observed_at", "callsign", "origin_country", "latitude", "longitude", "altitude_m", "on_ground",
    "velocity", "vertical_rate", "true_track", "squawk", "region", "has_usable_position",
]

_TYPES = {f.name: f.dataType for f in schemas.BRONZE.fields} | {
    "flight_id": T.StringType(),
    "session_seq": T.LongType(),
    "observation_seq": T.LongType(),
    "altitude_m": T.DoubleType(),
    "has_usable_position": T.BooleanType(),
    "seconds_since_previous": T.LongType(),
    "is_session_start": T.IntegerType(),
    "flight_phase": T.StringType(),
    "batch": T.LongType(),
    "bucket": T.IntegerType(),
}
_PUBLISHED = T.StructType(
    [T.StructField(c, _TYPES[c]) for c in (*SESSION_COLUMNS, "observation_seq", "batch", "bucket")]
)


def bucket_of(icao24: str = "icao24") -> Column:
    return F.pmod(F.xxhash64(icao24), F.lit(BUCKETS)).cast("int")


def advance(rows: DataFrame, state: DataFrame, params: Params = Params()) -> DataFrame:
    """Sessions of silver rows that are newer than their aircraft's state, if it has one."""
    if params.boundary != "takeoff_row":
        raise ValueError("a stream cannot look ahead; use boundary='takeoff_row'")
    numbered = sessionize(
        rows,
        key=["icao24"],
        ts="observed_at",
        gap_s=params.session_gap_seconds,
        state_col="on_ground",
        chunk_s=params.chunk_seconds,
        carry=state,
    )
    return numbered.withColumns(
        {
            "flight_id": flight_id(),
            "flight_phase": flight_phase(deadband=params.vertical_rate_deadband),
        }
    ).select(*SESSION_COLUMNS, "observation_seq")


def left_in(sessions: DataFrame) -> DataFrame:
    """The state each aircraft is left in; all four measures grow with time."""
    return sessions.groupBy("icao24").agg(
        F.max("observed_at").alias("last_ts"),
        F.max_by("on_ground", "observed_at").alias("last_state"),
        F.max("observation_seq").alias("last_seq"),
        F.max("session_seq").alias("last_session"),
    )


def _state(spark: SparkSession, path: str, before: int) -> DataFrame:
    """The newest state of every aircraft among batches before one."""
    stored = read_runs(spark, f"{path}/state", _STATES, before)
    return latest_per_key(stored, ["icao24"], ["batch"]).drop("batch").where("last_ts IS NOT NULL")


def undominated(marks: DataFrame, start: str = "since") -> DataFrame:
    """Marks without those that a later one of the aircraft, with the same start or an earlier one, contains."""
    later = W.partitionBy("icao24").orderBy(F.desc("batch")).rowsBetween(W.unboundedPreceding, -1)
    seen = F.min(start).over(later)
    return marks.withColumn("_seen", seen).where(F.col("_seen").isNull() | (F.col(start) < F.col("_seen"))).drop("_seen")


def standing(rows: DataFrame, marks: DataFrame, start: str = "since", at: str = "observed_at") -> DataFrame:
    """The rows that no mark of a later batch supersedes."""
    listed = marks.groupBy("icao24").agg(F.collect_list(F.struct("batch", start)).alias("_marks"))
    over = F.exists("_marks", lambda m: (m["batch"] > F.col("batch")) & (m[start] <= F.col(at)))
    return rows.join(listed, "icao24", "left").where(~F.coalesce(over, F.lit(False))).drop("_marks")


def published(spark: SparkSession, path: str, before: int | None = None, of: DataFrame | None = None) -> DataFrame:
    """Sessions as they stand, with ``observation_seq``; ``of`` names the aircraft that are wanted.

    Then only these aircraft's buckets are read.
    """
    rows = read_runs(spark, f"{path}/sessions", _PUBLISHED, before)
    marks = read_runs(spark, f"{path}/marks", MARK, before).where("late")
    if of is not None:
        buckets = [r.bucket for r in of.select(bucket_of().alias("bucket")).distinct().collect()]  # BUCKETS at most
        rows = rows.where(F.col("bucket").isin(buckets)).join(of.select("icao24").distinct(), "icao24", "left_semi")
        marks = marks.join(of.select("icao24").distinct(), "icao24", "left_semi")
    return standing(rows, undominated(marks))


def number_batch(arrived: DataFrame, path: str, batch_id: int, params: Params = Params()) -> DataFrame:
    """Fold a batch into silver and sessions; gives the batch's marks, a row per aircraft."""
    spark = arrived.sparkSession
    merge_latest(arrived, f"{path}/silver", batch_id)
    keys = arrived.select("icao24", "observed_at").distinct()
    touched = (
        arrived.groupBy("icao24")
        .agg(F.min("observed_at").alias("since"))
        .join(_state(spark, path, batch_id), "icao24", "left")
        .withColumn("late", F.coalesce(F.col("since") <= F.col("last_ts"), F.lit(False)))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    held = [touched]
    late = touched.where("late").select("icao24", "since")
    # The batch's observations in their latest copies: only the batch's hours are read.
    hours = arrived.select(F.to_date("observed_at").alias("date"), F.hour("observed_at").alias("hour"))
    latest = read_hours(spark, f"{path}/silver", hours, before=batch_id + 1).join(keys, ["icao24", "observed_at"], "left_semi")
    fresh = positioned(latest, params).select(*_INPUT)
    state = touched.where("NOT late AND last_ts IS NOT NULL").select(*STATE.fieldNames())
    if not late.isEmpty():
        history = published(spark, path, batch_id, late).join(late, "icao24").persist(StorageLevel.MEMORY_AND_DISK)
        held.append(history)
        after = history.where("observed_at >= since").join(keys, ["icao24", "observed_at"], "left_anti")
        fresh = fresh.unionByName(after.select(*_INPUT))
        state = state.unionByName(left_in(history.where("observed_at < since")))
    fresh, state = (df.persist(StorageLevel.MEMORY_AND_DISK) for df in (fresh, state))
    number = F.lit(batch_id).cast("bigint").alias("batch")
    sessions = advance(fresh, state, params).select("*", number, bucket_of().alias("bucket"))
    sessions = sessions.select(*_PUBLISHED.fieldNames()).persist(StorageLevel.MEMORY_AND_DISK)
    held += [fresh, state, sessions]
    try:
        write_run(sessions.hint("rebalance", "bucket"), f"{path}/sessions", batch_id, batch_id, ["bucket"])
        first = state.select("icao24", F.col("last_session").alias("from_session"))
        marks = touched.select("icao24", "since", "late", number).join(first, "icao24", "left")
        write_run(marks.select(*MARK.fieldNames()).hint("rebalance"), f"{path}/marks", batch_id, batch_id)
        # Aircraft without new rows keep their state; one that lost all its rows has none.
        now = touched.select("icao24").join(state, "icao24", "left").unionByName(left_in(sessions))
        write_run(latest_per_key(now, ["icao24"], ["last_ts"]).select("*", number), f"{path}/state", batch_id, batch_id)
    finally:
        for df in held:
            df.unpersist()
    _merge(spark, path, batch_id)
    return spark.read.schema(MARK).parquet(f"{path}/marks/run={batch_id}-{batch_id}")


def _merge(spark: SparkSession, path: str, batch_id: int) -> None:
    """Merge the runs of a table each; superseded rows and marks are left out."""
    marks = undominated(read_runs(spark, f"{path}/marks", MARK, before=batch_id + 1).where("late"))
    merge_runs(
        spark, f"{path}/sessions", _PUBLISHED, batch_id,
        lambda rows: standing(rows, marks).hint("rebalance", "bucket").sortWithinPartitions("bucket", "icao24", "observed_at"),
        partition_by=["bucket"],
    )
    merge_runs(spark, f"{path}/marks", MARK, batch_id, lambda m: undominated(m.where("late")), whole=True)
    merge_runs(spark, f"{path}/state", _STATES, batch_id, lambda s: latest_per_key(s, ["icao24"], ["batch"]), whole=True)


def start_sessions(
    bronze: DataFrame, path: str, checkpoint: str, params: Params = Params(), bounded: bool = True
) -> StreamingQuery:
    """Keep ``silver``, ``sessions``, ``marks`` and ``state`` under ``path`` up to date."""

    def step(batch: DataFrame, batch_id: int) -> None:
        arrived = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            number_batch(arrived, path, batch_id, params)
        finally:
            arrived.unpersist()

    trigger = {"availableNow": True} if bounded else {"processingTime": "30 seconds"}
    return (
        bronze.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """All sessions as they stand: of an aircraft, the rows since it was last numbered anew."""
    return published(spark, path).select(*SESSION_COLUMNS)
