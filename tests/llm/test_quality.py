import zlib

import numpy as np
import pytest


from waypost.llm.quality import Model, features, fit, keep_good, score

TABLES = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{TABLES}/documents.parquet"), spark.read.parquet(f"{TABLES}/labels.parquet")


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    found = score(docs, fit(docs, labels)).join(labels, "doc_id").filter("held_out").collect()
    assert len(found) > 500 and all(0 <= r.score <= 1 for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    right = sum(r.predicted == r.quality for r in found) / len(found)
    good = [r.predicted for r in found if r.quality == 1]
    bad = [r.predicted for r in found if r.quality == 0]
    assert right > 0.95 and np.mean(good) > 0.97 and np.mean(bad) < 0.25, (right, np.mean(good), np.mean(bad))


def test_labels_of_held_out_rows_change_nothing(spark, tables):
    docs, labels = tables
    small = docs.limit(300)
    some = labels.join(small, "doc_id").select("doc_id", "quality")
    turned = some.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    assert np.array_equal(fit(small, some).weights, fit(small, turned).weights)
    assert np.count_nonzero(fit(small, some, sample_rows=40).weights) > 0


def test_features():
    slots, values = features("a b a")
    assert len(slots) == 5 and abs((values[:-1] ** 2).sum() - 1) < 1e-12 and values[-1] == 1
    assert features("")[0].tolist() == [1 << 18]


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "good text", "a", 1.0), (2, None, "b", None), (2, "", "b", None), (None, "x " * 200_000, None, 2.0)],
        "doc_id long, text string, label string, score double",
    )
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, None), (3, 0)], "doc_id long, quality int")
    model = fit(docs, labels)
    rows = score(docs, model).collect()
    assert len(rows) == 4 and len({r.score for r in rows if r.doc_id == 2}) == 1
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    kept = keep_good(docs, model)
    assert kept.columns == docs.columns
    unlearnt = fit(docs, labels.limit(0))
    assert {r.score for r in score(docs, unlearnt).collect()} == {0.5}
    assert score(docs.limit(0), Model(model.weights)).collect() == []
