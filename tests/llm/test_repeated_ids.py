import numpy as np

from waypost.llm import decontaminate
from waypost.llm.quality import fit, held_out


def test_repeated_ids_are_learnt_from_once(spark):
    texts = [(d, f"{'good fine' if d % 2 else 'bad poor'} word{d} word{d % 7}") for d in range(40)]
    labels = spark.createDataFrame([(d, d % 2) for d, _ in texts], "doc_id long, quality int")
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    hot = labels.filter(~held_out(labels.doc_id)).first().doc_id
    more = spark.createDataFrame(texts + [texts[hot]] * 500, "doc_id long, text string").repartition(5)
    once = fit(docs, labels, bits=10, steps=400).weights
    assert once.any() and np.array_equal(once, fit(more, labels, bits=10, steps=400).weights)


def test_blocks_of_items_are_bounded_and_left_behind(spark, monkeypatch):
    sizes, real = [], decontaminate.Index.__init__
    monkeypatch.setattr(
        decontaminate.Index,
        "__init__",
        lambda self, items, *rest: (sizes.append(sum(len(t or "") for _, t in items)), real(self, items, *rest))[1],
    )
    text = " ".join(f"w{i}" for i in range(20))
    others = [" ".join(f"x{k}y{i}" for i in range(20)) for k in range(30)]
    items = spark.createDataFrame([(k, text) for k in range(200)] + [(300 + k, t) for k, t in enumerate(others)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a " + text + " b"), (2, others[3]), (3, "none")], "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items, block_bytes=1500).collect()}
    assert found == {(1, k) for k in range(200)} | {(2, 303)}
    assert sum(sizes) == len(text) + sum(map(len, others)) and max(sizes) < 4000
