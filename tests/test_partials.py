"""Counts kept with each batch against counts over all of bronze."""

from pyspark.sql import functions as F

from rows import bronze
from waypost import schemas, stats
from waypost.plans import partials as P
from waypost.plans.serving import partition_stats, stats_from_partials


FIRST = [
    {"t": 0}, {"t": 0}, {"t": 0, "region": "r2"}, {"t": 3599}, {"t": 3600},
    {"t": 5, "icao24": "b"}, {"t": 5, "icao24": "b", "region": "r2"},
]
SECOND = [{"t": 0}, {"t": 3600, "region": "r3"}, {"t": 7300, "icao24": "c"}]


def totals(spark):
    metrics = spark.createDataFrame([], schemas.INGEST_METRICS)
    flights = spark.createDataFrame([(True,)], "is_complete boolean")
    return metrics, flights


def test_partials_of_batches_give_the_headline_of_all(spark, tmp_path):
    path = str(tmp_path / "partials")
    P.add_partials(bronze(spark, *FIRST), path, 0)
    P.add_partials(bronze(spark, *SECOND), path, 1)
    P.add_partials(bronze(spark, *SECOND), path, 1)  # a batch that is retried counts once
    both = bronze(spark, *FIRST, *SECOND)
    kept = P.read_partials(spark, path)
    assert stats_from_partials(kept, *totals(spark)).collect() == stats(both, *totals(spark)).collect()
    for row in P.hour_stats(kept).collect():
        hour = both.where(F.date_trunc("hour", "observed_at") == F.lit(row.hour))
        assert partition_stats(hour).first() == (row.rows, row.distinct_aircraft, row.duplicate_rows)


def test_merged_runs_hold_the_same(spark, tmp_path):
    path = str(tmp_path / "partials")
    for n, rows in enumerate([FIRST, SECOND, FIRST, SECOND]):
        P.write_run(P.observation_partials(bronze(spark, *rows)), path, n, n)
        P.merge_runs(spark, path, P.PARTIALS, n, P.merge_partials, every=2)
    kept = P.read_partials(spark, path)
    assert kept.groupBy(*P.KEYS).count().where("count > 2").isEmpty()  # two merged runs
    assert P.headline(kept).first().raw_rows == 2 * len(FIRST + SECOND)
    assert P.headline(kept).first().distinct_observations == 5
    assert {len(r.seen) for r in kept.collect()} == {450}


def test_no_rows_give_an_empty_headline(spark, tmp_path):
    P.add_partials(bronze(spark), str(tmp_path / "p"), 0)
    assert tuple(P.headline(P.read_partials(spark, str(tmp_path / "p"))).first()) == (0, 0, 0, None, [])
    assert tuple(P.headline(P.read_partials(spark, str(tmp_path / "none"))).first())[:3] == (0, 0, 0)


def test_a_pass_over_bronze_reads_three_columns_and_combines_first(spark, tmp_path):
    path = str(tmp_path / "b")
    bronze(spark, *FIRST).write.parquet(path)
    plan = P.observation_partials(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<icao24:string,observed_at:timestamp,region:string>" in plan
    assert "partial_bitmap_construct_agg" in plan and plan.count("Exchange") == 1


def test_narrow_rows_are_shuffled_and_no_bitmaps(spark):
    plan = P.observation_partials(bronze(spark, *FIRST))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_bitmap_construct_agg") < plan.index("Exchange")


def test_landed_text_and_quarantine_are_compressed_and_landed_files_go(spark, tmp_path, monkeypatch):
    from waypost.catalog import streams

    landed = []
    start = streams.start_bronze

    def seen(source, paths, **options):
        landed.extend(p for p in tmp_path.glob("landing-*/*") if p.name.startswith("part-"))
        return start(source, paths, **options)

    monkeypatch.setattr(streams, "start_bronze", seen)
    monkeypatch.setattr(streams, "fresh_path", lambda _, name: str(tmp_path / f"{name}-1"))
    paths = streams._ingest(spark, "/root/testdata/sf0.001", True, 2, 1)
    rejected = [p for p in tmp_path.glob("ingest-1/quarantine/*/*") if p.name.startswith("part-")]
    assert landed and {p.suffix for p in landed + rejected} == {".lz4"}
    assert spark.read.json(paths.quarantine).count() > 0 and not (tmp_path / "landing-1").exists()
