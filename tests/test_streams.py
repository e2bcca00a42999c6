import json
from pathlib import Path

import pytest

from rows import BASE, T0, at, bronze
from test_records import RECORD
from waypost import Params, flight_sessions, flights, hourly_traffic, schemas, state_vectors, stream_ndjson
from waypost.plans.serving import latest_positions
from waypost.sinks.tables import write_bronze_table
from waypost.streaming import ingest
from waypost.streaming.ingest import IngestPaths, await_bronze, start_bronze
from waypost.streaming.live import read_live, start_live
from waypost.streaming.marts import read_flights, read_traffic, rebuild_flights, rebuild_traffic
from waypost.streaming.sessions import number_batch, published, read_sessions, start_sessions
from waypost.streaming.silver import drop_superseded, merge_latest, read_latest, start_silver, stream_bronze
from waypost.workspace import shared_root


def paths(tmp_path):
    return IngestPaths(*[str(tmp_path / n) for n in ("bronze", "quarantine", "metrics", "checkpoint", "table")])


def land(tmp_path, name, *records):
    folder = tmp_path / "landing"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")
    return str(folder)


def test_ingest_resumes_after_its_last_commit(spark, tmp_path):
    where = paths(tmp_path)
    late = RECORD | {"observed_at": T0 - 7200, "icao24": "late"}
    folder = land(tmp_path, "1.ndjson", RECORD, RECORD, "{broken", late)
    start_bronze(stream_ndjson(spark, folder), where, bounded=True).awaitTermination()
    land(tmp_path, "2.ndjson", RECORD | {"icao24": "second"})
    start_bronze(stream_ndjson(spark, folder), where, bounded=True).awaitTermination()

    written = spark.read.parquet(where.bronze)
    assert sorted(r.icao24 for r in written.collect()) == ["abc123", "abc123", "late", "second"]
    assert written.where("icao24 = 'late'").first().hour == 22
    assert spark.read.parquet(where.table).count() == 4
    rejected = spark.read.json(where.quarantine).collect()
    assert [(r.reason, r.payload) for r in rejected] == [("json: unparseable", "{broken")]
    metrics = spark.read.parquet(where.metrics).orderBy("batch_at").collect()
    assert [tuple(m)[1:5] for m in metrics] == [(4, 3, 1, 2), (1, 1, 0, 1)]


def test_a_retried_batch_counts_once(spark, tmp_path, monkeypatch):
    """The batch fails after bronze, the table and the quarantine are written."""
    where = paths(tmp_path)
    folder = land(tmp_path, "1.ndjson", RECORD, RECORD | {"icao24": "two"}, "{broken")

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "write_quarantine", lambda rows, path, mode: (rows.write.mode(mode).json(path), fail()))
        with pytest.raises(Exception, match="lost"):
            start_bronze(stream_ndjson(spark, folder), where, bounded=True).awaitTermination()
    start_bronze(stream_ndjson(spark, folder), where, bounded=True).awaitTermination()
    assert spark.read.parquet(where.bronze).count() == spark.read.parquet(where.table).count() == 2
    assert spark.read.json(where.quarantine).count() == 1
    assert [tuple(m)[1:5] for m in spark.read.schema(schemas.INGEST_METRICS).parquet(where.metrics).collect()] == [(3, 2, 1, 2)]


def test_ingest_stops_after_so_many_batches(spark, tmp_path):
    where = paths(tmp_path)
    for n in range(5):
        folder = land(tmp_path, f"{n}.ndjson", RECORD | {"icao24": f"a{n}"})
    source = stream_ndjson(spark, folder, 1)
    assert await_bronze(start_bronze(source, where, bounded=True, max_batches=2)).batches == 2
    assert spark.read.parquet(where.bronze).count() == 2
    assert await_bronze(start_bronze(stream_ndjson(spark, folder, 1), where, bounded=True)).batches == 3
    assert spark.read.parquet(where.bronze).count() == 5


def test_lost_metrics_are_counted(spark, tmp_path):
    where = paths(tmp_path)
    folder = land(tmp_path, "1.ndjson", RECORD)
    (tmp_path / "metrics").write_text("a file where the folder should be")
    job = start_bronze(stream_ndjson(spark, folder), where, bounded=True)
    assert await_bronze(job).lost_metrics == 1 and spark.read.parquet(where.bronze).count() == 1


def test_ingest_stops_when_the_schema_breaks(spark, tmp_path):
    where = paths(tmp_path)
    folder = land(tmp_path, "1.ndjson", *["{broken"] * 10, *[RECORD] * 100)
    query = start_bronze(stream_ndjson(spark, folder), where, bounded=True)
    with pytest.raises(Exception, match="messages are invalid"):
        query.awaitTermination()
    assert not (tmp_path / "bronze").exists()


def test_a_batch_is_validated_once(spark, tmp_path):
    """However many targets read it: one execution per batch parses JSON, the others scan its table."""
    where = paths(tmp_path)
    for n in range(2):
        folder = land(tmp_path, f"{n}.ndjson", RECORD | {"icao24": f"a{n}"}, RECORD | {"icao24": f"a{n}"}, "{broken")
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    start_bronze(stream_ndjson(spark, folder, 1), where, bounded=True).awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs = store.executionsList(int(before), 1000)
    plans = [runs.apply(k).physicalPlanDescription() for k in range(runs.size())]
    assert sum("from_json" in p and "WriteFiles" in p for p in plans) == 2
    assert not any("InMemoryTableScan" in p for p in plans)
    assert sum("WriteFiles" in p and "from_json" not in p for p in plans) == 2 * 4  # bronze, table, quarantine, metrics
    metrics = spark.read.parquet(where.metrics).collect()
    assert [tuple(m)[1:5] for m in metrics] == [(3, 2, 1, 1)] * 2
    assert not list(Path(shared_root(spark)).glob("ingest-*/*.parquet"))


def test_silver_merge_equals_batch_and_repeats_safely(spark, tmp_path):
    first = bronze(spark, {"t": 0, "callsign": "A"}, {"t": 0, "callsign": "B", "ingested_at": at(5)}, {"t": 90_000})
    second = bronze(spark, {"t": 0, "callsign": "C", "ingested_at": at(3)}, {"t": 5})
    path = str(tmp_path / "silver")
    merge_latest(first, path, 0)
    for _ in range(2):  # a retried batch
        merge_latest(second, path, 1)
    expected = {
        (r.observed_at, r.callsign, r.source_row_count) for r in state_vectors(first.unionByName(second)).collect()
    }
    got = {(r.observed_at, r.callsign, r.source_row_count) for r in read_latest(spark, path).collect()}
    assert read_latest(spark, path).count() == len(got)
    assert got == expected and (at(0).timestamp(), "B", 3) in {(o.timestamp(), c, n) for o, c, n in got}


def test_what_is_written_follows_the_batch(spark, tmp_path):
    path = str(tmp_path / "silver")
    merge_latest(bronze(spark, *[{"t": 60 * m} for m in range(24 * 60)]), path, 0)
    merge_latest(bronze(spark, {"t": 7230, "ingested_at": at(99_000)}), path, 1)
    written = spark.read.parquet(path + "/hours").where("batch = 1")
    assert written.count() == 1 and read_latest(spark, path).count() == 24 * 60 + 1


def test_an_hour_of_many_batches_becomes_a_snapshot(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("waypost.streaming.silver.DELTAS", 2)
    monkeypatch.setattr("waypost.streaming.runs.MERGE_EVERY", 3)
    path, every = str(tmp_path / "silver"), []
    for n in range(8):
        batch = [{"t": 7, "ingested_at": at(n % 3)}, {"t": 60 * n, "icao24": "b"}, {"t": 4000 if n % 4 == 0 else 8}]
        every += batch
        for _ in range(1 + n % 2):  # some batches are retried
            merge_latest(bronze(spark, *batch), path, n)
        merged, whole = read_latest(spark, path), state_vectors(bronze(spark, *every))
        assert merged.exceptAll(whole.select(*merged.columns)).isEmpty() and merged.count() == whole.count()
    hour = tmp_path / "silver" / "hours" / "date=2024-01-01" / "hour=00"
    assert len(list(hour.glob("batch=*"))) == 8
    drop_superseded(spark, path)
    assert sorted(p.name for p in hour.glob("batch=*")) == ["batch=6", "batch=7"]
    assert read_latest(spark, path).exceptAll(merged).isEmpty() and read_latest(spark, path).count() == whole.count()
    assert sorted(p.name for p in (tmp_path / "silver" / "manifest").glob("run=*")) == [
        "run=0-2", "run=0-5", "run=3-3", "run=4-4", "run=5-5", "run=6-6", "run=7-7",
    ]


def test_a_fix_that_aged_between_its_copies_is_not_live(spark, tmp_path):
    """Polled at 50 s and again at 70 s: the latest copy is stale, in whichever batch it comes."""
    copies = [{"t": 0, "position_age_seconds": age, "ingested_at": at(age)} for age in (50, 70)]
    for order in (copies, copies[::-1]):
        root = tmp_path / str(order[0]["position_age_seconds"])
        for copy in order:
            write_bronze_table(bronze(spark, copy), str(root / "b"))
            start_live(stream_bronze(spark, str(root / "b")), str(root / "l"), str(root / "c")).awaitTermination()
        assert read_live(spark, str(root / "l"), at(70)).isEmpty()


def test_live_keeps_no_more_than_it_may_show(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("waypost.streaming.runs.MERGE_EVERY", 4)
    for n in range(5):
        write_bronze_table(bronze(spark, {"t": 1000 * n, "icao24": f"a{n}"}), str(tmp_path / "b"))
        job = start_live(stream_bronze(spark, str(tmp_path / "b")), str(tmp_path / "l"), str(tmp_path / "c"))
        job.awaitTermination()
    state = job.recentProgress[-1]["stateOperators"][0]
    assert state["numRowsTotal"] <= 2 and any("rocksdb" in name for name in state["customMetrics"])
    merged = [p for p in (tmp_path / "l").glob("run=*") if len(set(p.name[4:].split("-"))) > 1]
    assert merged and all(spark.read.parquet(str(p)).count() == 1 for p in merged)
    assert [r.icao24 for r in read_live(spark, str(tmp_path / "l"), at(4000)).collect()] == ["a4"]


def test_silver_and_live_streams(spark, tmp_path):
    path = str(tmp_path / "b")
    rows = [{"t": t, "icao24": k, "ingested_at": at(t + c)} for t in (0, 60, 120) for k in ("a", "b") for c in (0, 9)]
    write_bronze_table(bronze(spark, *rows[::2]), path)
    write_bronze_table(bronze(spark, *rows[1::2], {"t": 300, "icao24": "a", "position_age_seconds": 99}), path)
    raw = spark.read.parquet(path).select(*schemas.BRONZE_COLUMNS)
    start_silver(stream_bronze(spark, path, 1), str(tmp_path / "s"), str(tmp_path / "sc")).awaitTermination()
    merged = read_latest(spark, str(tmp_path / "s"))
    batch = state_vectors(raw).select(*merged.columns)
    assert merged.exceptAll(batch).isEmpty() and batch.exceptAll(merged).isEmpty()

    start_live(stream_bronze(spark, path, 1), str(tmp_path / "l"), str(tmp_path / "lc")).awaitTermination()
    live = read_live(spark, str(tmp_path / "l"), at(120))
    expected = latest_positions(state_vectors(raw), at(120))
    assert live.exceptAll(expected).isEmpty() and live.count() == expected.count() == 2


def test_sessions_equal_the_batch_in_any_order(spark, tmp_path):
    rows = [
        {"t": t, "icao24": k, "on_ground": ground}
        for k in ("a", "b")
        for t, ground in ((0, True), (10, False), (20, False), (2000, False), (2010, True), (2020, False), (9000, False))
    ]
    parts = [
        [r for r in rows if r["t"] < 15],
        [r for r in rows if r["t"] > 2005] + [{"t": 2015, "icao24": "new"}],
        [r for r in rows if 15 <= r["t"] <= 2005 and r["icao24"] == "a"],  # late
        [{"t": 9500, "icao24": "b"}],
        [{"t": 2010, "icao24": "b", "latitude": None, "ingested_at": at(9999)}],  # a later copy without a place
        [r for r in rows if 15 <= r["t"] <= 2005 and r["icao24"] == "b"],
    ]
    root = tmp_path / "x"
    for n, part in enumerate(parts):
        write_bronze_table(bronze(spark, *part), str(root / "bronze"))
        stream = stream_bronze(spark, str(root / "bronze"))
        start_sessions(stream, str(root / "out"), str(root / "ckpt")).awaitTermination()
        seen = bronze(spark, *[r for p in parts[: n + 1] for r in p])
        streamed, batch = read_sessions(spark, str(root / "out")), flight_sessions(state_vectors(seen))
        assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty(), n
    assert not (root / "out" / "late").exists()


def test_sessions_survive_merges_and_retries(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("waypost.streaming.runs.MERGE_EVERY", 2)
    path, every = str(tmp_path / "o"), []
    for n in range(5):
        batch = [{"t": 600 * n, "icao24": "ab"[n % 2]}]
        batch += [{"t": 600, "icao24": "b", "latitude": None, "ingested_at": at(9999)}] if n == 2 else []
        batch += [{"t": 300, "icao24": "a"}] if n == 3 else []
        every += batch
        for _ in range(2 if n == 3 else 1):  # retried with its merge
            number_batch(bronze(spark, *batch), path, n)
    streamed, whole = read_sessions(spark, path), flight_sessions(state_vectors(bronze(spark, *every)))
    assert streamed.exceptAll(whole).isEmpty() and whole.exceptAll(streamed).isEmpty()
    assert sorted(p.name for p in (tmp_path / "o" / "sessions").glob("run=*")) == [
        "run=0-1", "run=2-2", "run=2-3", "run=3-3", "run=4-4",
    ]


def test_a_batch_reads_its_hours_and_its_late_aircraft_only(spark, tmp_path):
    """All other files are broken, so that a batch that opened one would fail."""
    path = str(tmp_path / "o")
    names = [f"a{n}" for n in range(40)]
    number_batch(bronze(spark, *[{"t": t, "icao24": k} for t in (0, 90_000, 180_000) for k in names]), path, 0)
    seen = {r.icao24: r.bucket for r in published(spark, path).select("icao24", "bucket").distinct().collect()}
    for file in (tmp_path / "o" / "silver" / "hours").rglob("*.parquet"):
        if "date=2024-01-03" not in str(file):
            file.write_bytes(b"broken")
    for file in (tmp_path / "o" / "sessions").rglob("*.parquet"):
        if f"bucket={seen['a7']}/" not in str(file):
            file.write_bytes(b"broken")
    number_batch(bronze(spark, {"t": 181_000, "icao24": "new"}, {"t": 180_100, "icao24": "a3"}), path, 1)
    number_batch(bronze(spark, {"t": 179_990, "icao24": "a7"}), path, 2)
    rows = published(spark, path, of=spark.createDataFrame([("a7",)], "icao24 string")).orderBy("observed_at").collect()
    assert [(r.observation_seq, r.session_seq) for r in rows] == [(1, 1), (2, 2), (3, 3), (4, 3)]


def test_marts_follow_late_rows_and_touch_nothing_else(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("waypost.streaming.runs.MERGE_EVERY", 3)
    path, every, params = str(tmp_path / "o"), [], Params(min_flight_observations=1)
    airports = spark.createDataFrame([("EHAM", "AMS", "A", "N", 50.0, 4.0, 1)], schemas.AIRPORTS)
    batches = [
        [{"t": t, "icao24": k} for k in ("a", "b") for t in (0, 10, 5000, 5010, 9000, 90_000)],
        [{"t": 20, "icao24": "a"}, {"t": 9010, "icao24": "a"}],  # late for a
        [{"t": 2500, "icao24": "b"}, {"t": 1300, "icao24": "b"}, {"t": 3700, "icao24": "b"}],  # joins two flights of b
        [{"t": 90_000, "icao24": "a", "latitude": None, "ingested_at": at(99_999)}],  # an hour and a flight less
    ]
    for n, batch in enumerate(batches):
        every += batch
        before = {p: p.stat().st_mtime_ns for p in (tmp_path / "o").glob("traffic/*/*/*.parquet")}
        for _ in range(2 if n == 2 else 1):  # one is retried
            arrived = bronze(spark, *batch)
            changed = number_batch(arrived, path, n, params)
            hours = arrived.selectExpr("to_date(observed_at) AS date", "hour(observed_at) AS hour").distinct()
            rebuild_traffic(spark, path, hours, n, params)
            rebuild_flights(spark, path, changed, airports, n, params)
        touched = {at(0).replace(day=1 + r["t"] // 86_400, hour=r["t"] % 86_400 // 3600).strftime("date=%Y-%m-%d/hour=%H") for r in batch}
        for file, changed_at in before.items():
            hour = "/".join(file.parts[-3:-1])
            assert (hour in touched) != (file.exists() and file.stat().st_mtime_ns == changed_at)
    silver = state_vectors(bronze(spark, *every), params)
    for got, want in (
        (read_flights(spark, path), flights(flight_sessions(silver, params), airports, params)),
        (read_traffic(spark, path), hourly_traffic(silver, params)),
    ):
        got = got.select(*want.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_stream_cannot_look_ahead(spark, tmp_path):
    from waypost.streaming.sessions import STATE, advance

    silver = state_vectors(bronze(spark, BASE))
    with pytest.raises(ValueError):
        advance(silver, spark.createDataFrame([], STATE), Params(boundary="last_ground_row"))


def test_traffic_of_a_batch_is_not_computed_in_one_task(spark, tmp_path, monkeypatch):
    rows = bronze(spark, {"t": 0}, {"t": 9}, {"t": 4000})
    narrowed, kind = [], type(rows)
    plain = kind.coalesce
    monkeypatch.setattr(kind, "coalesce", lambda df, n: narrowed.append(df.columns) or plain(df, n))
    number_batch(rows, str(tmp_path), 0)
    hours = rows.selectExpr("to_date(observed_at) AS date", "hour(observed_at) AS hour")
    rebuild_traffic(spark, str(tmp_path), hours, 0)
    assert not any("traffic_hour" in columns for columns in narrowed)
    assert sorted(r.observations for r in read_traffic(spark, str(tmp_path)).collect()) == [1, 2]


def test_landed_files_grow_in_number_and_not_in_size(spark, monkeypatch):
    """More events give more files, and more of them to a batch: batches stay as many."""
    from waypost.catalog import streams

    seen = []
    plain = streams.stream_ndjson
    monkeypatch.setattr(streams, "stream_ndjson", lambda s, path, n: seen.append((len(s.read.text(path).inputFiles()), n)) or plain(s, path, n))
    monkeypatch.setattr(streams, "FILE_EVENTS", 10)
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    assert streams.str_bounded(spark, "/root/testdata/sf0.001").first().batches == 1
    assert seen[0][0] >= events // 10
