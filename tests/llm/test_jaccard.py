import random

import numpy as np
import pytest

from waypost.llm.components import components
from waypost.llm.jaccard import Sizes, drop_near_copies, jaccard_components, set_keys

SCHEMA = "doc_id long, text string, family string, cls int"


def shingles(text, n):
    w = "".join(c.lower() if c.isascii() else c for c in (text or "")).split()
    n = min(n, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if n else frozenset()


def brute(rows, n, p, q):
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if rows[i][0] == rows[j][0] or both and q * both >= p * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    names = {}
    for i, (d, _) in enumerate(rows):
        names[root(i)] = min(names.get(root(i), d), d)
    return sorted((d, len(sets[i]), names[root(i)]) for i, (d, _) in enumerate(rows))


def corpus(seed):
    """Families of edited copies with similarities on both sides of the threshold."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(900)}" if r.random() < 0.8 else r.choice(["The", "the", "é"])
    common = [word() for _ in range(60)]
    texts = [None, "", " \n", "one", "One", "two words", "two  words", "a b c"]
    for _ in range(25):
        base = [word() for _ in range(r.choice([3, 6, 9, 15, 30, 80, 200, 400]))]
        if r.random() < 0.4:
            base[r.randrange(len(base)) :] += common
        texts.append(" ".join(base))
        for _ in range(r.choice([0, 1, 2, 6, 14])):
            w = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 3, 1 + len(w) // 25])):
                k = r.randrange(len(w))
                w[k : k + r.choice([0, 1, 1])] = [word()] * r.choice([0, 1, 1])
                w = w or ["x"]
            texts.append(" ".join(w))
    ids = r.sample(range(10_000), len(texts))
    return list(zip(ids, texts))


@pytest.mark.parametrize(("n", "p", "tile"), [(4, 85, 250_000), (5, 80, 900)])
def test_components_equal_brute_force(spark, monkeypatch, n, p, tile):
    monkeypatch.setattr("waypost.llm.jaccard.TILE_GRAMS", tile)  # small tiles cut families up
    monkeypatch.setattr("waypost.llm.jaccard.BLOCK_KEYS", 2_000)
    rows = corpus(n)
    docs = spark.createDataFrame([(*x, "f", 1) for x in rows], SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in jaccard_components(docs, n=n, share=(p, 100)).collect())
    want = brute(rows, n, p, 100)
    assert len({w[2] for w in want}) < len(rows) - 20
    assert got == want


def test_similar_sets_share_enough_keys():
    """The keys alone, on many random pairs near the threshold and on tiny sets."""
    r = np.random.default_rng(1)
    for p, sizes in ((85, Sizes((85, 100))), (80, Sizes((80, 100)))):
        for _ in range(3000):
            n = int(r.choice([5, 7, 8, 12, 20, 45, 130, 700]))
            a = np.unique(r.integers(0, 2**64, n, dtype=np.uint64))
            lost = int(r.integers(0, max(2, n // 5)))
            new = r.integers(0, 2**64, int(r.integers(0, max(2, n // 8))), dtype=np.uint64)
            b = np.unique(np.concatenate((a[lost:], new)))
            both = len(np.intersect1d(a, b))
            if len(b) and 100 * both >= p * (len(a) + len(b) - both) and both < max(len(a), len(b)):
                (keys_a, need_a), (keys_b, need_b) = set_keys(a, sizes), set_keys(b, sizes)
                assert len(np.intersect1d(keys_a, keys_b)) >= max(need_a, need_b)


def test_null_and_repeated_ids_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(40))
    near = text.replace("w39", "x")
    docs = spark.createDataFrame(
        [(None, text, "a", 1), (4, text, "a", 1), (4, text, "a", 1), (9, near, None, None), (4, "else", "a", 1), (5, None, "a", 1)], SCHEMA
    )
    got = sorted(map(str, (tuple(r) for r in jaccard_components(docs).collect())))
    assert got == sorted(map(str, [(None, 36, None), (4, 36, 4), (4, 36, 4), (9, 36, 4), (4, 1, 4), (5, 0, 5)]))
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["4", "4", "4", "5", "None"]
    assert jaccard_components(docs.limit(0)).collect() == []


def test_components(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 100), (7, 3), (7, 3), (201, 200), (None, 3)]
    r = random.Random(1)
    r.shuffle(path)
    got = {n: root for n, root in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
