"""Each stage of the pipeline against plain Python, on the smallest tables."""

import duckdb
import public_tokenizers
import pytest
from test_decontaminate import shingles as item_shingles
from test_exact_dedup import norm
from test_jaccard import brute as brute_components
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from waypost.llm.quality import GOOD, fit, score

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage, each written and read again."""
    root, docs, found = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{root}/{name}")
        after = spark.read.parquet(f"{root}/{name}")
        found[name] = (docs, after)
        docs = after
    return found


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_all_but_the_last_return_the_columns_of_documents(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.dtypes == before.dtypes, name
        kept = texts(after)
        assert set(kept) <= set(texts(before)) and all(texts(before)[d] == t for d, t in kept.items()), name


def test_quality(spark, stages):
    before, after = stages["quality_classifier"]
    model = fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r.doc_id: r.score for r in score(before, model).collect()}
    assert set(texts(after)) == {d for d, s in scores.items() if s >= GOOD} < set(scores)


def test_exact(stages):
    before, after = (texts(df) for df in stages["exact_dedup"])
    first = {}
    for d in sorted(before):
        first.setdefault(norm(before[d]), d)
    assert set(after) == set(first.values())


def test_near(stages):
    before, after = (texts(df) for df in stages["ngram_jaccard_join"])
    assert set(after) == {c for _, _, c in brute_components(list(before.items()), 5, 80, 100)}


def test_benchmark(stages):
    before, after = (texts(df) for df in stages["benchmark_decontamination"])
    items = [item_shingles(t) for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    leaked = {
        d for d, t in before.items() if any(s and 5 * len(item_shingles(t.replace("\n", " ")) & s) >= 4 * len(s) for s in items)
    }
    assert set(after) == set(before) - leaked


def test_packing(stages):
    before, packed = stages["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in sorted(packed.collect(), key=lambda r: r.start):
        pieces[r.doc_id] = pieces.get(r.doc_id, b"") + bytes(r.ids)
    want = {
        d: b"".join(i.to_bytes(4, "little") for i in [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1])
        for d, t in texts(before).items()
    }
    assert pieces == want


def test_run_and_registration(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "ngram_jaccard_join", "benchmark_decontamination", "packing",
    ]
    found = entry_points.queries()
    assert found["pipeline"] is corpus_pipeline.run
    assert {n.split("_")[0] for n in found if n.startswith("op")} == {f"op{n}" for n in range(1, 14)}
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_exact_dedup_query_matches_its_sql(spark):
    from oracle import compare, connect

    query = "op1_exact_dedup"
    assert compare(entry_points.queries()[query](spark, SF), connect(SF), entry_points.oracle_sql()[query]) == ""
