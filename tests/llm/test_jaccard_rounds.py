"""The product in rounds, and rows that go without a shuffle of those that stay."""

import os

import corpus_pipeline
import numpy as np
import pytest
from test_jaccard import SCHEMA, brute, corpus

from waypost.llm import jaccard
from waypost.llm.jaccard import drop_near_copies, jaccard_components


def frame(spark, rows):
    return spark.createDataFrame([(*x, "f", 1) for x in rows], SCHEMA).repartition(3)


def test_no_round_gathers_all_sets(spark, monkeypatch):
    """And a family larger than a round is dealt to its tiles' tasks in several steps."""
    monkeypatch.setattr(jaccard, "ROUND_GRAMS", 3_000)
    monkeypatch.setattr(jaccard, "TILE_GRAMS", 900)
    tables = {}
    settle = jaccard.settle

    def seen(df, name):
        out = settle(df, name)
        tables.setdefault(name, []).append(sum(r.n for r in out.select("n").collect()) if name == "sets" else out.count())
        return out

    monkeypatch.setattr(jaccard, "settle", seen)
    rows = []
    for k in range(4):  # corpora that have no words in common
        rows += [(d + 10_000 * k, t and " ".join(f"c{k}{w}" for w in t.split())) for d, t in corpus(5 + k)]
    got = sorted(tuple(r) for r in jaccard_components(frame(spark, rows), n=5, share=(80, 100)).collect())
    assert got == brute(rows, 5, 80, 100)
    assert len(tables["sets"]) > 2 and max(tables["sets"]) < 0.6 * sum(tables["sets"])
    assert len(tables["product-links"]) > len(tables["sets"])


def test_sent_keys_keep_their_first_bits_and_order():
    keys = np.sort(np.random.default_rng(3).integers(0, 2**64, 5_000, dtype=np.uint64))
    sent = jaccard._packed(keys)
    assert len(sent) == 5_000 * jaccard.KEY_BYTES
    assert (jaccard._unpacked(sent) >> np.uint64(16) == keys >> np.uint64(16)).all()


def test_an_owner_counts_once_for_a_key_however_often_it_is_sent():
    keys = np.array([5, 5, 5, 7, 7, 9], np.uint64)
    owners = np.array([2, 1, 2, 2, 2, 1], np.int32)
    key, low, a, b, n = jaccard._stars(keys, owners)
    assert key.tolist() == [5, 7, 9] and low.tolist() == [1, 2, 1]
    assert (a.tolist(), b.tolist(), n.tolist()) == ([2], [1], [1])


@pytest.mark.parametrize("words", [1, 1 << 12])
def test_rows_that_stay_are_not_shuffled(spark, monkeypatch, words):
    """Nearly all of them; a bitmap of one word leaves it to the join."""
    monkeypatch.setattr(jaccard, "FILTER_WORDS", words)
    rows = corpus(6) + [(None, "no id"), (None, None), (7_000_000_000, "one alone"), (7_000_000_000, "one alone")]
    docs = frame(spark, rows)
    root = {d: c for d, _, c in brute([r for r in rows if r[0] is not None], 5, 80, 100)}
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (tuple(r)[:2] for r in kept.collect()))) == sorted(str(r) for r in rows if r[0] is None or root[r[0]] == r[0])
    joined = sum(line.count("SortMergeJoin LeftAnti") for line in kept._jdf.queryExecution().executedPlan().toString().split("\n"))
    assert joined == 0 or "_go" in kept._jdf.queryExecution().optimizedPlan().toString()


def test_the_pipeline_keeps_no_table_of_an_earlier_stage(spark, monkeypatch):
    written = []

    def seen(df, name):
        out = settle(df, name)
        written.append((name, out.inputFiles()[0].removeprefix("file:").rpartition("/")[0]))
        return out

    settle = corpus_pipeline.settle
    monkeypatch.setattr(corpus_pipeline, "settle", seen)
    packed = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert [name for name, _ in written] == [name for name, _ in corpus_pipeline.STAGES]
    assert [os.path.exists(at) for _, at in written] == [False] * (len(written) - 1) + [True]
    assert packed.count() > 0
