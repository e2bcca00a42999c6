"""Tables bucketed by aircraft and time slice."""

import uuid

from pyspark.sql import functions as F

from rows import bronze
from waypost.params import Params
from waypost.plans.flights import flight_sessions
from waypost.plans.silver import state_vectors
from waypost.sinks.buckets import SLICE, open_bucketed, write_bucketed

DAY = 86_400


def name() -> str:
    return f"t_{uuid.uuid4().hex}"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def history(spark):
    """One aircraft has most rows; copies, ground rows and gaps over day ends included."""
    rows = [{"t": t, "on_ground": t % 7 == 0} for t in range(0, 4 * DAY, 3000)]
    rows += [{"t": t, "icao24": f"x{t % 5}", "on_ground": t % 3 == 0} for t in range(0, 3 * DAY, 40_000)]
    return bronze(spark, *rows, *rows[::4])


def test_sessions_over_buckets_move_summaries_only(spark, tmp_path):
    raw = history(spark)
    stored = write_bucketed(raw, name(), str(tmp_path / "bronze"), buckets=8)
    vectors = state_vectors(stored, slice_col=SLICE)
    assert "Exchange" not in plan(vectors)
    silver = write_bucketed(vectors, name(), str(tmp_path / "silver"), buckets=8)
    found = flight_sessions(silver, Params(), SLICE)
    # With the summaries' side not broadcast: it is brought to the buckets, not they to it.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(flight_sessions(silver, Params(), SLICE))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above_scan, moved = [], []
    for line in text.splitlines():
        if "Exchange" in line:
            moved.append(line)
        if "FileScan" in line:
            above_scan.append(line)
    assert len(above_scan) == 2 and 1 <= len(moved) <= 2
    row_side = text[text.index("SortMergeJoin") :] if "SortMergeJoin" in text else text[text.index("Join") :]
    first_scan = row_side.index("FileScan")
    assert "Exchange" not in row_side[:first_scan]

    plain = flight_sessions(state_vectors(raw), Params())
    assert sorted(found.collect()) == sorted(plain.collect())


def test_a_hot_aircraft_is_spread_over_buckets(spark, tmp_path):
    write_bucketed(history(spark), name(), str(tmp_path / "b"), buckets=8)
    files = spark.read.parquet(str(tmp_path / "b")).where("icao24 = 'abc123'")
    assert files.select(F.input_file_name()).distinct().count() > 1
    assert len(list((tmp_path / "b").glob("*.parquet"))) <= 8  # a file a bucket


def test_another_application_opens_the_same_buckets(spark, tmp_path):
    stored = write_bucketed(history(spark), name(), str(tmp_path / "b"), buckets=8)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored.schema.fields)
    again = open_bucketed(spark, name(), str(tmp_path / "b"), schema, buckets=8)
    assert again.exceptAll(stored).isEmpty()
    assert "Exchange" not in plan(again.groupBy("icao24", SLICE).count())


def test_empty_and_null_rows(spark, tmp_path):
    none = write_bucketed(bronze(spark), name(), str(tmp_path / "e"), buckets=4)
    assert none.isEmpty() and SLICE in none.columns
    rows = bronze(spark, {"t": 1}, {}).withColumn(
        "observed_at", F.when(F.unix_seconds("observed_at") % 2 == 0, F.col("observed_at"))
    )
    assert write_bucketed(rows, name(), str(tmp_path / "n"), buckets=4).count() == 2
