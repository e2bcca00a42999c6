import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rows import T0, at, bronze
from waypost import Params, ewma, flight_sessions, flights, running_total, sessionize, state_vectors
from waypost.schemas import AIRPORTS


def session_starts(spark, rows, params=Params()):
    out = flight_sessions(state_vectors(bronze(spark, *rows)), params).orderBy("icao24", "observed_at")
    return [(r.session_seq, r.is_session_start, r.seconds_since_previous) for r in out.collect()]


def test_gap_is_strictly_greater(spark):
    assert session_starts(spark, [{"t": 0}, {"t": 1800}, {"t": 3601}]) == [
        (1, 1, None), (1, 0, 1800), (2, 1, 1801),
    ]


def test_takeoff_splits_and_landing_does_not(spark):
    rows = [{"t": 0, "on_ground": True}, {"t": 1}, {"t": 2}, {"t": 3, "on_ground": True}]
    assert [s for s, _, _ in session_starts(spark, rows)] == [1, 2, 2, 2]
    early = Params(boundary="last_ground_row")
    rows = [{"t": 0, "on_ground": True}, {"t": 5, "on_ground": True}, {"t": 6}, {"t": 7, "on_ground": True}]
    assert [s for s, _, _ in session_starts(spark, rows, early)] == [1, 2, 2, 2]


def test_first_row_has_no_gap(spark):
    assert session_starts(spark, [{"t": 50}]) == [(1, 1, None)]


def reference_windows(df, gap, boundary):
    """The same rules as one window per key."""
    w = W.partitionBy("k").orderBy("ts")
    prev, prev_g, next_g = F.lag("ts").over(w), F.lag("g").over(w), F.lead("g").over(w)
    gap_s = F.unix_seconds("ts") - F.unix_seconds(prev)
    change = (prev_g & ~F.col("g")) if boundary == "takeoff_row" else (F.col("g") & ~next_g)
    start = (gap_s.isNull() | (gap_s > gap) | F.coalesce(change, F.lit(False))).cast("int")
    flagged = df.withColumns(
        {"observation_seq": F.row_number().over(w), "previous_ts": prev, "previous_state": prev_g,
         "seconds_since_previous": gap_s, "is_session_start": start}
    )
    return flagged.withColumn(
        "session_seq", F.sum("is_session_start").over(w.rowsBetween(W.unboundedPreceding, 0))
    )


@pytest.mark.parametrize("boundary", ["takeoff_row", "last_ground_row"])
@pytest.mark.parametrize("chunk", [7, 60, 86_400])
def test_sliced_history_equals_one_window(spark, boundary, chunk):
    random.seed(chunk)
    rows = [
        (k, at(t), random.random() < 0.4 if random.random() < 0.9 else None)
        for k in ("hot", "b", "c")
        for t in random.sample(range(0, 4000), 400 if k == "hot" else 15)
    ]
    df = spark.createDataFrame(rows, "k string, ts timestamp, g boolean")
    ours = sessionize(df, ["k"], "ts", 40, "g", boundary=boundary, chunk_s=chunk)
    expected = reference_windows(df, 40, boundary).select(*ours.columns)
    key = lambda r: (r.k, r.ts)
    assert [tuple(r) for r in sorted(ours.collect(), key=key)] == [
        tuple(r) for r in sorted(expected.collect(), key=key)
    ]


def test_sessions_partition_the_observations(spark):
    df = spark.range(500).select(
        (F.col("id") % 7).cast("string").alias("k"),
        F.timestamp_seconds(F.lit(T0) + F.col("id") * F.col("id") % 90_000 * 7 + F.col("id")).alias("ts"),
    ).dropDuplicates(["k", "ts"])
    out = sessionize(df, ["k"], "ts", 300).cache()
    assert out.count() == df.count()
    dense = out.groupBy("k").agg(F.max("session_seq").alias("m"), F.count_distinct("session_seq").alias("d"))
    assert dense.where("m <> d").isEmpty()
    assert out.where("is_session_start = 1 AND seconds_since_previous <= 300").isEmpty()
    out.unpersist()


def airports(spark, *points):
    rows = [(code, None, f"name {code}", "X", lat, lon, 0) for code, lat, lon in points]
    return spark.createDataFrame(rows, AIRPORTS)


def fact(spark, rows, params=Params(), points=(("AAAA", 50.0, 4.0),)):
    sessions = flight_sessions(state_vectors(bronze(spark, *rows)), params)
    return flights(sessions, airports(spark, *points), params).collect()


def test_flown_flight_is_complete_only_from_the_ground(spark):
    rows = [{"t": 0, "on_ground": True}, *[{"t": 60 * i} for i in range(1, 4)], {"t": 300, "on_ground": True}]
    taken_off = [r for r in fact(spark, rows) if r.climb_observations + r.cruise_observations]
    assert [r.is_complete for r in taken_off] == [False]
    early = [r for r in fact(spark, rows, Params(boundary="last_ground_row"))]
    assert [(r.is_complete, r.reconstruction_quality) for r in early] == [(True, "high")]


def test_gap_before_a_session_counts_unless_scoped(spark):
    rows = [{"t": 0}, *[{"t": 4000 + 10 * i} for i in range(12)]]
    assert [(r.max_gap_seconds, r.reconstruction_quality) for r in fact(spark, rows)] == [(4000, "low")]
    scoped = fact(spark, rows, Params(gap_scope="within_session"))
    assert [(r.max_gap_seconds, r.reconstruction_quality) for r in scoped] == [(10, "medium")]


def test_gap_runs_over_unusable_rows(spark):
    rows = [{"t": 0}, {"t": 100, "position_age_seconds": 99}, {"t": 250}, {"t": 300}]
    (flight,) = fact(spark, rows)
    assert (flight.observation_count, flight.max_gap_seconds) == (3, 150)


def test_short_sessions_are_no_flights(spark):
    assert fact(spark, [{"t": 0}, {"t": 1}]) == []


def test_callsign_vote_and_regions(spark):
    names = ["BB", "AA", None, None, None, "BB", "AA"]
    rows = [{"t": i, "callsign": c, "region": f"r{i % 2}"} for i, c in enumerate(names)]
    (flight,) = fact(spark, rows)
    assert flight.callsign == "AA" and flight.regions_seen == ["r0", "r1"]


def test_unmatched_endpoint_is_null(spark):
    (flight,) = fact(spark, [{"t": i} for i in range(3)], points=(("FAR", 10.0, 10.0),))
    assert flight.departure_airport is None and flight.arrival_airport_name is None
    assert len(flight) == 32


def test_running_total_over_slices(spark):
    rows = [("a", at(t), t % 5) for t in range(0, 5000, 13)] + [("b", at(t), 1) for t in range(20)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v long")
    out = running_total(df, ["k"], "ts", ["v"], "v", "total", chunk_s=100)
    expected = F.sum("v").over(W.partitionBy("k").orderBy("ts", "v").rowsBetween(W.unboundedPreceding, 0))
    assert out.withColumn("e", expected).where("e <> total").isEmpty()


@pytest.mark.parametrize("chunk", [50, 86_400])
def test_ewma_over_slices(spark, chunk):
    values = [(i * 37) % 101 for i in range(400)]
    df = spark.createDataFrame([("a", at(i * 5), v) for i, v in enumerate(values)], "k string, ts timestamp, v long")
    got = [r.ewma for r in ewma(df, "k", "ts", "v", 0.3, chunk).orderBy("ts").collect()]
    mean, expected = None, []
    for v in values:
        mean = float(v) if mean is None else 0.3 * v + 0.7 * mean
        expected.append(mean)
    assert got == pytest.approx(expected, abs=1e-9)
