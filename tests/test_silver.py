import pytest
from pyspark.sql import functions as F

from rows import at, bronze
from waypost import Params, dedup_latest, state_vectors
from waypost.functions import scalar as X
from waypost.plans.checks import check_dedup
from waypost.plans.serving import latest_positions, live


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_latest_copy_wins_and_copies_are_counted(spark):
    df = bronze(
        spark,
        {"callsign": "OLD", "ingested_at": at(10)},
        {"callsign": "NEW", "ingested_at": at(20)},
        {"callsign": "MID", "ingested_at": at(15)},
    )
    row = one(state_vectors(df))
    assert (row.callsign, row.source_row_count, row.ingested_at.timestamp()) == (
        "NEW", 3, at(20).timestamp(),
    )


def test_null_in_the_latest_copy(spark):
    df = bronze(
        spark,
        {"callsign": "OLD", "ingested_at": at(10)},
        {"callsign": None, "ingested_at": at(20)},
    )
    assert one(state_vectors(df)).callsign is None
    assert one(state_vectors(df, Params(null_policy="column"))).callsign == "OLD"


def test_version_ties_do_not_depend_on_arrival_order(spark):
    rows = [{"callsign": c, "velocity": v} for c, v in (("A", 9.0), ("B", 1.0), ("B", 2.0))]
    forwards, backwards = bronze(spark, *rows), bronze(spark, *reversed(rows))
    picked = [one(state_vectors(df.coalesce(1))) for df in (forwards, backwards)]
    assert picked[0] == picked[1]
    assert (picked[0].callsign, picked[0].velocity) == ("B", 2.0)


def test_collapsed_input_adds_up_its_counts(spark):
    df = bronze(spark, {}, {"ingested_at": at(5)}).withColumn("n", F.lit(4).cast("bigint"))
    row = one(dedup_latest(df, ["icao24", "observed_at"], "ingested_at", count_col="n"))
    assert row.source_row_count == 8


def test_unknown_null_policy(spark):
    with pytest.raises(ValueError):
        state_vectors(bronze(spark, {}), Params(null_policy="cell"))


def test_positionless_rows_leave_and_stale_rows_stay(spark):
    df = bronze(
        spark,
        {"t": 0, "latitude": None},
        {"t": 1, "position_age_seconds": 60},
        {"t": 2, "position_age_seconds": 61},
    )
    flags = {r.observed_at.timestamp() - at(0).timestamp(): r.has_usable_position
             for r in state_vectors(df).collect()}
    assert flags == {1: True, 2: False}


def test_zero_is_not_null(spark):
    row = one(state_vectors(bronze(spark, {"velocity": 0.0, "geo_altitude": None, "baro_altitude": 0.0})))
    assert row.velocity == 0.0 and row.altitude_m == 0.0


@pytest.mark.parametrize(
    ("ground", "rate", "phase"),
    [(True, 9.0, "ground"), (False, None, "unknown"), (False, 1.5, "cruise"), (False, 1.51, "climb"),
     (False, -1.5, "cruise"), (False, -1.51, "descent")],
)
def test_flight_phase(spark, ground, rate, phase):
    df = bronze(spark, {"on_ground": ground, "vertical_rate": rate})
    assert one(df.select(X.flight_phase().alias("p"))).p == phase


def test_contact_only_key_never_meets_a_fix(spark):
    df = spark.sql("SELECT 'a' AS i, CAST(5 AS BIGINT) AS tp, CAST(9 AS BIGINT) AS lc UNION ALL SELECT 'a', NULL, 5")
    keys = {r.k for r in df.select(X.dedup_key("i", "tp", "lc").alias("k")).collect()}
    assert keys == {"a:5", "a:c5"}


def test_percent_ties_round_up(spark):
    df = spark.sql("SELECT 3 AS part, 80 AS whole UNION ALL SELECT 1, 0")
    assert {r.p for r in df.select(X.safe_percent("part", "whole").alias("p")).collect()} == {3.8, None}


def test_live_drops_stale_fixes_before_choosing(spark):
    silver = state_vectors(
        bronze(spark, {"t": 0}, {"t": 10, "position_age_seconds": 500}, {"t": 0, "icao24": "old"})
    )
    rows = live(silver, at(900)).collect()
    assert {r.icao24 for r in rows} == {"abc123", "old"}
    assert all(r.observed_at.timestamp() == at(0).timestamp() for r in rows)
    assert latest_positions(silver, at(901)).count() == 0
    with pytest.raises(ValueError):
        live(silver, limit=10_001)


def test_dedup_check_flags_a_zero_rate(spark):
    clean = one(check_dedup(state_vectors(bronze(spark, {"t": 0}, {"t": 1}))))
    assert clean.passed and clean.suspicious_zero
    empty = one(check_dedup(state_vectors(bronze(spark, {"latitude": None}))))
    assert not empty.passed and empty.detail == "no rows"
