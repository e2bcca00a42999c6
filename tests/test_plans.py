"""What the jobs cost: shuffles, broadcasts and scans."""

import datetime as dt
from functools import cache

import pytest
from pyspark.sql import functions as F

from waypost import dedup_latest, haversine_km, nearest_within, partition_stats, profile, region_yield, workspace
from waypost.catalog import standin as S
from waypost.operators.boxes import tag_regions
from waypost.plans.flights import flight_sessions, flight_summary
from waypost.plans.serving import latest_positions
from waypost.sinks.tables import write_bronze
from waypost.sources.polls import decode_vectors, read_envelopes, state_rows
from waypost.sources.tables import read_bronze

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@cache
def settled(spark):
    return workspace.settle(S.silver(spark, SF), "silver")


def test_dedup_combines_before_its_only_shuffle(spark):
    text = plan(dedup_latest(settled(spark).drop("source_row_count"), ["icao24", "observed_at"], "ingested_at"))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_max" in text


def test_no_history_is_ordered_in_one_task(spark):
    text = plan(flight_sessions(settled(spark), S.DAY_GAP))
    detail = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    # Rows move by aircraft and slice, twice; only summaries move by aircraft alone.
    assert sum("_slice" in line for line in detail) >= 2
    assert "SinglePartition" not in text


def test_the_summary_pass_reads_three_columns(spark):
    text = plan(flight_sessions(settled(spark), S.DAY_GAP))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    narrow = [s for s in scans if "ReadSchema: struct<icao24:string,observed_at:timestamp,on_ground:boolean>" in s]
    assert narrow


def test_flight_sums_hash_on_the_map_side(spark):
    text = plan(flight_summary(flight_sessions(settled(spark), S.DAY_GAP), S.DAY_GAP))
    assert "HashAggregate(keys=[icao24" in text and "partial_min_by" in text


def test_small_dimension_leaves_the_large_side_unshuffled(spark):
    vectors = S.vectors(spark, SF).select("event_id", "pos", "latitude", "longitude")
    text = plan(
        nearest_within(
            vectors, S.airports(spark, SF), ("latitude", "longitude"), ("latitude", "longitude"),
            "icao", {"icao": "icao"}, ["event_id", "pos"],
        )
    )
    assert "BroadcastHashJoin" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not any("event_id" in line for line in text.splitlines() if "Exchange hash" in line)


def test_region_tagging_is_an_equi_join(spark):
    text = plan(tag_regions(S.vectors(spark, SF), S.region_boxes(spark, SF)))
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_live_reads_only_recent_rows_and_its_columns(spark):
    text = plan(latest_positions(settled(spark), S.AS_OF, 900))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "GreaterThanOrEqual(observed_at" in scan and "EqualTo(has_usable_position,true)" in scan
    assert "squawk" not in scan.split("ReadSchema")[1]


def scans(df, kind):
    return plan(df).count(f"FileScan {kind}")


def test_the_profile_reads_its_recordings_three_times(spark, tmp_path):
    S.poll_documents(spark, SF).select("value").write.text(str(tmp_path / "polls"))
    envelopes = read_envelopes(spark, str(tmp_path / "polls"), lines=True)
    polls = state_rows(envelopes)
    vectors, _ = decode_vectors(polls)
    # Two passes have run and are written; the third is in the plan.
    assert scans(profile(envelopes, polls, vectors), "json") == 1


def test_region_yield_runs_its_input_once(spark, tmp_path):
    S.region_polls(spark, SF).write.json(str(tmp_path / "polls"))
    polls = spark.read.schema("region string, poll_time timestamp, vectors long").json(str(tmp_path / "polls"))
    assert scans(region_yield(polls, S.region_table(spark, SF)), "json") == 0


def test_an_hour_is_read_alone(spark, tmp_path):
    write_bronze(S.bronze(spark, SF), str(tmp_path / "b"))
    hour = read_bronze(spark, str(tmp_path / "b"), dt.datetime(2024, 1, 10, 12), dt.datetime(2024, 1, 10, 13))
    scan = next(line for line in plan(partition_stats(hour)).splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(date" in scan or "date#" in scan.split("PartitionFilters")[1]


def test_size_check_looks_at_bytes_too(spark):
    wide = spark.range(10).selectExpr("repeat('x', 1000) AS s")
    assert workspace.fits_broadcast(wide, 10) and not workspace.fits_broadcast(wide, 10, max_bytes=9_000)


def test_a_hot_cell_is_dealt_over_tasks(spark):
    """Half of all rows in one cell: its rows get several salts, other cells' points are not copied."""
    rows = spark.range(4000).selectExpr(
        "id", "CASE WHEN id % 2 = 0 THEN 50.0 ELSE 40.0 + (id % 999) / 50 END AS latitude", "10.0 AS longitude"
    )
    fields = spark.createDataFrame([("a", 50.0, 10.0), ("b", 41.0, 10.0)], "icao string, latitude double, longitude double")
    out = nearest_within(
        rows, fields, ("latitude", "longitude"), ("latitude", "longitude"), "icao", {"icao": "icao"}, ["id"],
        strategy="shuffle", cell_rows=100,
    )
    text = plan(out)
    assert "_salt" in text and "NestedLoop" not in text
    assert out.where("icao = 'a'").count() >= 2000
    plain = nearest_within(
        rows, fields, ("latitude", "longitude"), ("latitude", "longitude"), "icao", {"icao": "icao"}, ["id"], strategy="broadcast",
    )
    assert out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty()


def test_rows_without_a_position_are_dealt_over_tiles(spark):
    rows = spark.range(5000).selectExpr("id", "CAST(NULL AS double) AS latitude", "CAST(NULL AS double) AS longitude")
    regions = S.region_boxes(spark, SF)
    out = tag_regions(rows, regions, strategy="shuffle")
    assert "SortMergeJoin" in plan(out)
    assert out.count() == 5000 * regions.count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per_task = out.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["count"] for r in per_task) < out.count() / 2


def test_size_check_counts_no_further_than_needed(spark):
    assert workspace.fits_broadcast(spark.range(10), 10)
    assert not workspace.fits_broadcast(spark.range(11), 10)


def test_distance_stays_out_of_python(spark):
    text = plan(S.vectors(spark, SF).select(haversine_km("latitude", "longitude", F.lit(0.0), F.lit(0.0))))
    assert "Python" not in text


def test_shared_folder_is_the_one_the_cluster_names(spark, monkeypatch):
    assert workspace.shared_root(spark)

    class Context:
        applicationId = "x"
        master = "spark://host"

        @staticmethod
        def getConf():
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

        class conf:  # noqa: N801
            get = staticmethod(lambda *_: None)

    with pytest.raises(RuntimeError):
        workspace.shared_root(Session())
