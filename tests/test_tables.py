import datetime as dt
import json
import threading
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest

from rows import at, bronze
from test_records import RECORD
from waypost import MODEL_CHECKS, Check, partition_stats, read_bronze, run_checks, schemas, state_vectors, validate
from waypost.plans import serving as Q
from waypost.plans.checks import check_fresh, check_moved, check_plausible
from waypost.sinks import tables as sinks


def test_a_late_row_lands_in_its_own_hour(spark, tmp_path):
    path = str(tmp_path / "b")
    sinks.write_bronze(bronze(spark, {"t": 0}, {"t": 7200, "ingested_at": at(7300)}), path)
    sinks.write_bronze(bronze(spark, {"t": 30, "ingested_at": at(9000)}), path)
    hours = spark.read.schema(schemas.BRONZE_PARTITIONED).parquet(path).groupBy("hour").count().collect()
    assert {(r.hour, r["count"]) for r in hours} == {(0, 2), (2, 1)}
    assert (Path(path) / "date=2024-01-01" / "hour=00").is_dir()


def test_a_time_range_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "b")
    sinks.write_bronze(bronze(spark, *[{"t": 1800 * i} for i in range(120)]), path)
    start, end = dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 1)
    window = read_bronze(spark, path, start, end)
    assert window.count() == 4
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "date" in plan.split("PartitionFilters")[1].split("]")[0]


@pytest.mark.parametrize("hours", [-11, 0, 2, 13, None])
def test_bounds_are_instants(spark, tmp_path, hours):
    """A window and a retention cutoff are the same whatever zone they are written in."""
    zone = dt.timezone(dt.timedelta(hours=hours)) if hours is not None else None
    path = str(tmp_path / "b")
    sinks.write_bronze(bronze(spark, *[{"t": 3600 * h + 900} for h in range(60)]), path)

    def written(seconds):
        moment = at(seconds).astimezone(dt.timezone.utc)
        return moment.replace(tzinfo=None) if zone is None else moment.astimezone(zone)

    def seconds(rows):
        return sorted(int(r.observed_at.timestamp() - at(0).timestamp()) for r in rows.collect())

    low, high = 22 * 3600 + 1200, 51 * 3600 + 600
    expected = [3600 * h + 900 for h in range(60) if low <= 3600 * h + 900 < high]
    assert seconds(read_bronze(spark, path, written(low), written(high))) == expected
    sinks.apply_retention(spark, path, written(low + 30 * 86_400))
    assert seconds(read_bronze(spark, path)) == [3600 * h + 900 for h in range(60) if 3600 * h + 900 >= low]


@pytest.mark.parametrize("batches", [False, True])
def test_retention_of_the_daily_table(spark, tmp_path, batches):
    path = str(tmp_path / "t")
    rows = [bronze(spark, *[{"t": 7200 * h + n} for h in range(40)]) for n in range(2)]
    for n, part in enumerate(rows):
        sinks.write_bronze_table(part, path, batch=n if batches else None)
    early = bronze(spark, {"t": 86_400 + 60})
    sinks.write_bronze_table(early, path, batch=2 if batches else None)  # a batch that expires whole
    cutoff = 86_400 + 4 * 3600
    sinks.apply_retention(spark, path, at(cutoff + 30 * 86_400))
    kept = [int(r.observed_at.timestamp() - at(0).timestamp()) for r in spark.read.parquet(path).collect()]
    assert sorted(kept) == sorted(7200 * h + n for h in range(40) for n in range(2) if 7200 * h + n >= cutoff)
    assert {p.name for p in Path(path).glob("day=*")} == {"day=2024-01-02", "day=2024-01-03", "day=2024-01-04"}
    if batches:
        assert {p.name for p in Path(path).glob("day=2024-01-02/batch=*")} == {"batch=0", "batch=1"}


def test_a_batch_written_again_leaves_its_rows_once(spark, tmp_path):
    first, second = bronze(spark, {"t": 0}, {"t": 4000}), bronze(spark, {"t": 10}, {"t": 90_000})
    for write, name in ((sinks.write_bronze, "b"), (sinks.write_bronze_table, "t")):
        path = str(tmp_path / name)
        write(first, path, batch=0)
        write(second.limit(1), path, batch=1)  # what a failed attempt left
        write(second, path, batch=1)
        assert spark.read.parquet(path).count() == 4


def test_expired_metrics_go_batch_by_batch(spark, tmp_path):
    path = str(tmp_path / "m")
    for n in range(3):
        row = spark.createDataFrame([(at(86_400 * n), 1, 1, 0, 1)], schemas.INGEST_METRICS)
        row.write.parquet(f"{path}/batch={n}")
    sinks.expire_metrics(spark, path, at(86_400 * 91 + 5))
    assert sorted(p.name for p in Path(path).glob("batch=*")) == ["batch=2"]
    assert spark.read.parquet(path).count() == 1


def test_table_layout_is_sorted(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [{"t": t, "icao24": k} for k in ("b", "a") for t in (90_000, 5, 1)]
    sinks.write_bronze_table(bronze(spark, *rows), path)
    assert spark.read.parquet(path).count() == 6
    assert {p.name for p in Path(path).glob("day=*")} == {"day=2024-01-01", "day=2024-01-02"}


def test_retention_removes_only_what_expired(spark, tmp_path):
    path = str(tmp_path / "b")
    days = [{"t": 86_400 * d + 3600 * h + m * 60} for d in range(3) for h in (0, 5, 9) for m in (0, 30)]
    sinks.write_bronze(bronze(spark, *days), path)
    as_of = at(0) + dt.timedelta(days=31, hours=5, minutes=10)
    sinks.apply_retention(spark, path, as_of)
    kept = sorted(int(r.observed_at.timestamp() - at(0).timestamp()) for r in read_bronze(spark, path).collect())
    cutoff = 86_400 + 5 * 3600 + 600
    assert kept == [s for s in sorted(d["t"] for d in days) if s >= cutoff]
    # The hour of the cutoff empties altogether.
    sinks.apply_retention(spark, path, at(0) + dt.timedelta(days=31, hours=5, minutes=40))
    assert not (Path(path) / "date=2024-01-02" / "hour=05").exists()
    assert read_bronze(spark, path).count() == 8


def test_fanout_tries_all_targets(spark):
    tried = []

    def fine(rows):
        assert rows.is_cached  # all targets get the same rows, computed once
        tried.append("fine")

    def broken(_):
        tried.append("broken")
        raise OSError("disk")

    df = bronze(spark, {})
    targets = {"broken": broken, "fine": fine}
    with pytest.raises(sinks.FanoutError, match="broken"):
        sinks.write_fanout(df, targets)
    assert tried == ["broken", "fine"]
    assert sinks.write_fanout(df, targets, on_partial="continue") == {"broken": "disk", "fine": None}
    with pytest.raises(sinks.FanoutError):
        sinks.write_fanout(df, {"broken": broken}, on_partial="continue")


def test_batch_metrics_count_before_deduplication(spark):
    texts = [json.dumps(RECORD)] * 3 + ["{"]
    row = sinks.ingest_metrics(validate(spark.createDataFrame([(t,) for t in texts], "value string"))).first()
    assert (row.messages_consumed, row.rows_written, row.invalid_messages, row.distinct_observations) == (4, 3, 1, 1)
    assert check_moved(spark.createDataFrame([row], schemas.INGEST_METRICS)).first().passed
    assert not check_moved(spark.createDataFrame([], schemas.INGEST_METRICS)).first().passed


def test_ndjson_and_messages_keep_nulls(spark, tmp_path):
    df = bronze(spark, {}).select("icao24", "squawk")
    sinks.write_ndjson(df, str(tmp_path / "n"))
    assert spark.read.text(str(tmp_path / "n")).first().value == '{"icao24":"abc123","squawk":null}'
    message = sinks.keyed_messages(df).first()
    assert (message.key, message.value) == ("abc123", '{"icao24":"abc123","squawk":null}')


def test_materialize_swaps_when_written(spark, tmp_path):
    root = str(tmp_path / "models")
    first = sinks.materialize(bronze(spark, {"t": 1}, {"t": 0}), "swap_me", ["observed_at"], root)
    second = sinks.materialize(bronze(spark, {"t": 5}), "swap_me", root=root)
    # Any session finds the new version; readers of the one before are undisturbed.
    assert sinks.read_model(spark.newSession(), "swap_me", root).count() == 1 and second.count() == 1
    assert [r.observed_at for r in first.collect()] == sorted(r.observed_at for r in first.collect())
    # A rebuild that fails half way changes nothing.
    (tmp_path / "models" / "swap_me" / "version=2").mkdir()
    assert sinks.read_model(spark, "swap_me", root).count() == 1
    sinks.materialize(bronze(spark, {"t": 5}, {"t": 6}), "swap_me", root=root)
    assert sinks.read_model(spark, "swap_me", root).count() == 2
    assert not (tmp_path / "models" / "swap_me" / "version=0").exists()
    with pytest.raises(FileNotFoundError):
        sinks.read_model(spark, "nothing", root)


def test_two_rebuilds_at_a_time_write_two_versions(spark, tmp_path):
    root = str(tmp_path / "models")
    meet = threading.Barrier(2)

    def rebuild(t):
        rows = bronze(spark, *[{"t": t}] * 3)
        meet.wait()
        return sinks.materialize(rows, "raced", root=root)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(rebuild, (1, 2)))
    folders = sorted(p.name for p in (tmp_path / "models" / "raced").glob("version=*"))
    assert folders == ["version=0", "version=1"]
    for folder in folders:
        rows = spark.read.parquet(f"{root}/raced/{folder}")
        assert rows.count() == 3 and rows.select("observed_at").distinct().count() == 1
    # A number claimed by a writer that never came back is passed over.
    (tmp_path / "models" / "raced" / "claims" / "version=2").touch()
    assert sinks.materialize(bronze(spark, {"t": 9}), "raced", root=root).count() == 1
    assert (tmp_path / "models" / "raced" / "version=3").exists()


def test_a_view_follows_its_source_and_writes_nothing(spark, tmp_path):
    root = str(tmp_path / "models")
    view = sinks.materialize(bronze(spark, {"t": 1}, {"t": 2}), "as_view", root=root, how="view")
    assert view.count() == 2 and spark.table("as_view").count() == 2
    assert not (tmp_path / "models").exists()
    sinks.materialize(bronze(spark, {"t": 1}), "as_view", root=root, how="view")
    assert spark.table("as_view").count() == 1
    with pytest.raises(ValueError):
        sinks.materialize(view, "as_view", root=root, how="index")


def test_checks_report_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (9, "b"), (None, "c")], "n int, s string")
    rules = [
        Check("t", "not_null", ("s",)), Check("t", "range", ("n",), 1, 5), Check("t", "range", ("n",), high=9),
        Check("t", "values", ("s",), allowed=("a", "b")), Check("t", "unique", ("n",)),
        Check("other", "not_null", ("x",)),
    ]
    result = [(r.check, r.passed, r.violations) for r in run_checks({"t": df}, rules).collect()]
    assert result == [
        ("t.not_null.s", False, 1), ("t.range.n", False, 1), ("t.range.n", True, 0),
        ("t.values.s", False, 1), ("t.unique.n", False, 1),
    ]
    with pytest.raises(ValueError):
        run_checks({"nothing": df}, rules)


def test_model_checks_pass_on_silver(spark):
    silver = state_vectors(bronze(spark, {"t": 0}, {"t": 0}, {"t": 9}))
    out = run_checks({"state_vectors": silver}, MODEL_CHECKS)
    assert out.count() == 9 and out.where("NOT passed").isEmpty()


def test_freshness_levels(spark):
    df = bronze(spark, {"ingested_at": at(0)})
    got = [(r.passed, r.severity) for s in (1800, 1801, 7201) for r in check_fresh(df, at(s)).collect()]
    assert got == [(True, "warn"), (False, "warn"), (False, "error")]
    empty = check_fresh(df.where("false"), at(0)).first()
    assert (empty.passed, empty.severity, empty.detail) == (False, "warn", "table is empty")


def test_plausibility_counters(spark):
    df = spark.createDataFrame(
        [(-5, 100.0, 10.0, 2, at(9), at(4)), (10, 9000.0, 20.0, 5, at(0), at(10))],
        "duration_seconds long, max_altitude_m double, max_velocity_knots double, observation_count long,"
        " departure_time timestamp, arrival_time timestamp",
    )
    assert [(r.violations, r.passed) for r in check_plausible(df).collect()] == [(1, False)] * 4


def test_stats_take_the_duplicate_rate_from_metrics(spark):
    raw = bronze(spark, {"t": 0}, {"t": 0, "region": "r0"}, {"t": 5})
    fact = spark.createDataFrame([(True,), (False,)], "is_complete boolean")
    batches = spark.createDataFrame([(at(0), 9, 8, 1, 6)], schemas.INGEST_METRICS)
    row = Q.stats(raw, batches, fact).first()
    assert (row.raw_rows, row.distinct_observations, row.distinct_aircraft) == (3, 2, 1)
    assert (row.duplicate_rate_pct, row.flights_reconstructed, row.complete_flights) == (25.0, 2, 1)
    assert row.regions == ["r0", "r1"]
    nothing = Q.stats(raw, batches.where("false"), fact).first()
    assert nothing.duplicate_rate_pct == 0.0
    assert tuple(partition_stats(raw).first()) == (3, 1, 1)


def test_serving_limits(spark):
    fact = spark.createDataFrame([], "reconstruction_quality string")
    with pytest.raises(ValueError):
        Q.flight_list(fact, limit=0)
    with pytest.raises(ValueError):
        Q.flight_list(fact, min_quality="best")
    with pytest.raises(ValueError):
        Q.traffic_window(fact, hours=721)
    sessions = spark.createDataFrame(
        [], "flight_id string, icao24 string, observed_at timestamp, latitude double, longitude double,"
        " altitude_m double, velocity double, vertical_rate double, flight_phase string,"
        " seconds_since_previous long, has_usable_position boolean",
    )
    with pytest.raises(Q.NoTrack):
        Q.track(sessions, "abc-1")


def test_geojson_keeps_a_null_altitude(spark):
    positions = spark.createDataFrame(
        [("a", None, 50.0, 4.0, None, True)],
        "icao24 string, callsign string, latitude double, longitude double, altitude_m double, on_ground boolean",
    )
    feature = json.loads(Q.geojson_features(positions).first().feature)
    assert feature == {
        "type": "Feature",
        "geometry": {"type": "Point", "coordinates": [4.0, 50.0]},
        "properties": {"icao24": "a", "callsign": "", "altitude": None, "onGround": True},
    }
    assert tuple(Q.geojson_bounds(positions).first()) == (4.0, 50.0, 4.0, 50.0)
