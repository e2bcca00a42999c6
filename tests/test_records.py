import json

import pytest
from pyspark.sql import functions as F

from rows import BASE, T0, at
from waypost import (
    decode_vectors, field_drift, percentile_by_index, profile, ratio_verdict, read_airports,
    read_ndjson, read_polls, schemas, split_valid, time_shift, to_records, validate,
)
from waypost.sources.polls import read_envelopes, to_bronze, with_fields

RECORD = {
    c: (int(BASE[c].timestamp()) if c in schemas.EPOCH_COLUMNS else BASE[c])
    for c in schemas.BRONZE_COLUMNS
} | {"dedup_key": "abc123:1"}


def verdicts(spark, *payloads):
    texts = [p if isinstance(p, (str, type(None))) else json.dumps(p) for p in payloads]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, value string").coalesce(1)
    return [r for r in validate(df).orderBy("i").collect()]


def test_a_good_record_survives_whole(spark):
    (row,) = verdicts(spark, RECORD)
    assert row.reason is None
    got = row.rec.asDict()
    assert got["icao24"] == "abc123" and got["observed_at"].timestamp() == T0
    assert got["baro_altitude"] is None and got["velocity"] == 10.0
    valid, rejected = split_valid(validate(spark.createDataFrame([(json.dumps(RECORD),)], "value string")))
    assert valid.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.BRONZE.fields]
    assert rejected.isEmpty()


NUMBERS = ("latitude", "longitude", "baro_altitude", "velocity", "true_track", "vertical_rate", "geo_altitude")
TIMES = ("observed_at", "time_position", "last_contact", "poll_time", "ingested_at")
FLAGS = ("on_ground", "spi")
RANGES = {"latitude": (-90, 90), "longitude": (-180, 180), "category": (0, 20), "position_source": (0, 3)}
EPOCHS = (946_684_800, 4_102_444_800)


def cases():
    """(field, value, reason) for every rule, made from the rule rather than listed."""
    for field in ("icao24", "origin_country", "region"):
        yield field, None, f"{field}: required"
    for field in ("callsign", "squawk", "time_position", "category", *NUMBERS):
        yield field, None, None
    for field in ("icao24", "callsign", "origin_country", "squawk", "region"):
        for wrong in (7, -2.5, True, ["KL"], {"k": "v"}):
            yield field, wrong, f"{field}: not a string"
    for blank in ("", "   ", "\n\t"):
        yield "icao24", blank, "icao24: empty"
    for field in TIMES:
        for wrong in (False, "1706000000", 1_706_000_000.75, [1_706_000_000]):
            yield field, wrong, f"{field}: not an integer"
        yield field, EPOCHS[0], None
        yield field, EPOCHS[0] - 1, f"{field}: implausible epoch"
        yield field, 1_706_000_000_000, f"{field}: implausible epoch"  # milliseconds
    for field in NUMBERS:
        for wrong in (True, "12.5", [3], {"m": 3}):
            yield field, wrong, f"{field}: not a number"
        yield field, 7, None
    for field, (low, high) in RANGES.items():
        yield field, low, None
        yield field, high, None
        yield field, low - 1, f"{field}: out of range"
        yield field, high + 1, f"{field}: out of range"
    for field in ("category", "position_source"):
        for wrong in (False, "2", 1.5):
            yield field, wrong, f"{field}: not an integer"
    yield "position_source", None, "position_source: not an integer"
    for field in FLAGS:
        for wrong in (None, 0, "true", "no"):
            yield field, wrong, f"{field}: not a boolean"
    for wrong in (True, "soon", "1.5"):
        yield "position_age_seconds", wrong, "position_age_seconds: not a number"
    for fine in (None, "31", 0, 2.25):
        yield "position_age_seconds", fine, None


def test_rules(spark):
    judged = list(cases())
    rows = verdicts(spark, *[RECORD | {field: value} for field, value, _ in judged])
    wrong = [(c, r.reason) for c, r in zip(judged, rows) if r.reason != c[2]]
    assert wrong == []


def test_documents_that_are_no_record(spark):
    missing = {k: v for k, v in RECORD.items() if k != "last_contact"}
    rows = verdicts(
        spark, "", None, "{", "[1]", '"text"', "null", json.dumps(RECORD) + " trailing", missing,
        json.dumps(RECORD)[:-1] + ', "velocity": NaN}', [RECORD], "{}",
    )
    assert [r.reason for r in rows] == [
        "json: unparseable", "json: unparseable", "json: unparseable", "record: not an object",
        "record: not an object", "record: not an object", "json: unparseable",
        "last_contact: required", "json: unparseable", "record: not an object", "icao24: required",
    ]


def test_first_failing_rule_is_the_reason(spark):
    (row,) = verdicts(spark, RECORD | {"velocity": "fast", "latitude": 99, "region": None})
    assert row.reason == "latitude: out of range"


def test_age_is_cut_to_whole_seconds(spark):
    rows = verdicts(spark, *[RECORD | {"position_age_seconds": v} for v in (5.9, " 7 ", "", None, 12)])
    assert [r.rec.position_age_seconds for r in rows] == [5, 7, 0, 0, 12]


def test_drift_names_both_sides(spark):
    extra = RECORD | {"speed": 1}
    lacking = {k: v for k, v in RECORD.items() if k != "squawk"}
    df = spark.createDataFrame([(json.dumps(r),) for r in (RECORD, extra, lacking)], "value string")
    assert {tuple(r) for r in field_drift(df).collect()} == {("speed", "unexpected", 1), ("squawk", "missing", 1)}


def test_ratio_guard_needs_enough_messages(spark):
    def stop(good, bad):
        df = spark.createDataFrame([(json.dumps(RECORD),)] * good + [("{",)] * bad, "value string")
        return ratio_verdict(validate(df)).first()

    assert not stop(90, 9).stop
    assert not stop(95, 5).stop
    tripped = stop(94, 6)
    assert tripped.stop and tripped.samples == ["json: unparseable"] and tripped.invalid == 6


VECTOR = ["abc123", "KLM1    ", "X", T0, T0 + 3, 4.5, 52.0, None, False, 0, 90, None, None, 11.5, "0042", False, 0]


def write_polls(folder, *polls):
    for name, time, states in polls:
        (folder / name).write_text(json.dumps({"time": time, "states": states}))
    return str(folder / "states-*.json")


def test_polls_decode(spark, tmp_path):
    nothing = ["def", None, None, None, T0, None, None, None, None, None, None, None, None, None, None, None, None]
    path = write_polls(
        tmp_path, ("states-002.json", T0 + 10, [VECTOR + [7], VECTOR[:4]]), ("states-001.json", T0, [nothing]),
        ("states-003.json", T0 + 10, None), ("states-004.json", T0 + 20, [["x"] + VECTOR[1:4] + ["soon"] + VECTOR[5:]]),
    )
    polls = read_polls(spark, path)
    good, bad = decode_vectors(polls)
    rows = good.orderBy("file", "pos").collect()
    assert [r.icao24 for r in rows] == ["def", "abc123"]
    zero, full = rows
    # Required fields take their zero value, optional ones stay absent.
    assert (zero.origin_country, zero.on_ground, zero.spi, zero.position_source) == ("", False, False, 0)
    assert zero.velocity is None and zero.category is None and zero.callsign is None
    assert (full.velocity, full.category, full.squawk, full.geo_altitude) == (0.0, 7, "0042", 11.5)
    assert {r.reason for r in bad.collect()} == {"4 fields", "last_contact: not a bigint"}
    assert not [c for c in good.columns if c.startswith("_") or c in ("raw", "v")]

    records = to_records(good, F.lit(T0 + 99), F.lit("r")).orderBy("icao24").collect()
    assert (records[0].callsign, records[0].dedup_key, records[0].position_age_seconds) == (
        "KLM1", f"abc123:{T0}", 3,
    )
    assert (records[1].observed_at, records[1].dedup_key) == (T0, f"def:c{T0}")
    assert to_bronze(to_records(good, F.lit(T0), F.lit("r"))).dtypes == [
        (f.name, f.dataType.simpleString()) for f in schemas.BRONZE.fields
    ]

    shifted = {r.file: r for r in time_shift(good, T0 + 1000).collect()}
    assert shifted["states-001.json"].poll_time == T0 + 1000
    assert shifted["states-002.json"].poll_time == T0 + 1010
    assert shifted["states-002.json"].time_position == T0 + 1000
    assert shifted["states-001.json"].time_position is None


def test_an_element_of_another_json_type_is_rejected(spark, tmp_path):
    """Whatever its text would read as."""

    def put(at, value):
        return [*VECTOR[:at], value, *VECTOR[at + 1 :]]

    wrong = [
        (put(0, 31), "icao24: not a string"), (put(1, False), "callsign: not a string"),
        (put(3, str(T0)), "time_position: not a bigint"), (put(4, T0 + 0.5), "last_contact: not a bigint"),
        (put(6, "52.5"), "latitude: not a double"), (put(8, "false"), "on_ground: not a boolean"),
        (put(8, 0), "on_ground: not a boolean"), (put(15, 1), "spi: not a boolean"),
        (put(16, 70_000), "position_source: not a smallint"), (VECTOR + ["7"], "category: not a smallint"),
        ([], "0 fields"),
    ]
    fine = [put(9, 3), put(9, -1.5e2), put(12, [1, 2]), put(1, 'q"\\,]'), VECTOR + [None], VECTOR + [3, "extra", [1]]]
    path = write_polls(tmp_path, ("states-1.json", T0, [v for v, _ in wrong]), ("states-2.json", T0, fine))
    good, bad = decode_vectors(read_polls(spark, path))
    assert [r.reason for r in bad.orderBy("pos").collect()] == [reason for _, reason in wrong]
    rows = good.orderBy("pos").collect()
    assert len(rows) == len(fine) and rows[1].velocity == -150.0 and rows[3].callsign == 'q"\\,]'


def test_broken_and_absent_recordings_are_errors(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_polls(spark, str(tmp_path / "states-*.json")).count()
    (tmp_path / "states-1.json").write_text('{"time":1,"states":[[')
    with pytest.raises(Exception):
        read_polls(spark, str(tmp_path / "states-*.json")).collect()


def test_profile_of_recordings(spark, tmp_path):
    def v(icao, fix, contact, ground):
        return [icao, "C", "X", fix, contact, 1.0, 1.0, None, ground, 0, 0, 0, None, 0, "1", False, 0]

    path = write_polls(
        tmp_path,
        ("states-01.json", T0, [v("a", T0, T0, True), v("b", T0, T0 + 20, False), v("c", None, T0, False)]),
        ("states-02.json", T0, [v("a", T0, T0 + 5, True), v("b", T0, T0 + 5, False)]),
        ("states-03.json", T0 + 30, [v("a", T0, T0 + 9, False), v("c", None, T0, False), v("c", T0, T0, False)]),
    )
    polls = read_polls(spark, path)
    good, _ = decode_vectors(polls)
    m = {r.metric: r.value for r in profile(read_envelopes(spark, path), polls, good).collect()}
    assert (m["polls"], m["mean_interval_s"], m["vectors_with_fields_17"]) == (3, 15, 8)
    assert (m["duplicates_overall"], m["duplicates_on_ground"], m["duplicates_airborne"]) == (4, 1, 3)
    assert (m["staleness_p50"], m["staleness_max"]) == (5, 20)
    assert m["staleness_over_10s_pct"] == pytest.approx(100 / 6)
    assert (m["null_pct_sensors"], m["null_pct_time_position"], m["null_pct_category"]) == (100, 25, 0)


def test_percentile_takes_the_indexed_value(spark):
    df = spark.range(10).select(F.col("id").cast("int").alias("v"))
    got = {r.p: r.value for r in percentile_by_index(df, "v", [0, 50, 90, 99, 100]).collect()}
    assert got == {0: 0, 50: 5, 90: 9, 99: 9, 100: 9}
    wide = spark.createDataFrame([(-(10**9),), (-1,), (0,), (70_000,), (10**9,)], "v int")
    got = {r.p: r.value for r in percentile_by_index(wide, "v", [0, 20, 40, 60, 80]).collect()}
    assert got == {0: -(10**9), 20: -1, 40: 0, 60: 70_000, 80: 10**9}
    assert [r.value for r in percentile_by_index(wide.where("v > 1e9"), "v", [50]).collect()] == [0]


def test_text_sources(spark, tmp_path):
    (tmp_path / "r.ndjson").write_text('{"a":1}\nbroken\n')
    assert {r.value for r in read_ndjson(spark, str(tmp_path / "r.ndjson")).collect()} == {'{"a":1}', "broken"}
    header = "icao,iata,name,country,latitude,longitude,elevation_m\n"
    (tmp_path / "a.csv").write_text(header + "EGLL,LHR,Heathrow,UK,51.47,-0.46,25\n")
    row = read_airports(spark, str(tmp_path / "a.csv")).first()
    assert (row.icao, row.latitude, row.elevation_m) == ("EGLL", 51.47, 25)
    (tmp_path / "b.csv").write_text(header.replace("iata", "code") + "EGLL,LHR,Heathrow,UK,51.47,-0.46,25\n")
    with pytest.raises(Exception):
        read_airports(spark, str(tmp_path / "b.csv")).collect()


def test_a_vector_is_parsed_once_however_many_rules_look_at_it(spark):
    polls = with_fields(spark.range(3).selectExpr("'f' AS file", "id AS poll_time", "0 AS pos", "concat('[', id, ']') AS raw"))
    plan = decode_vectors(polls)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(ArrayType(StringType") == 1 and plan.count("raw") < 20
