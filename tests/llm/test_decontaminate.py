import random

from waypost.llm.decontaminate import drop_leaks, find_leaks, sketch_length

SCHEMA = "doc_id long, text string, item_id string, n_held string"


def shingles(text, n=5):
    w = [x for x in "".join(c.lower() if c.isascii() else c for c in (text or "")).split(" ") if x]
    n = min(n, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def data():
    r = random.Random(2)
    word = lambda: r.choice(["the", "Of", "and", "é"]) if r.random() < 0.3 else f"w{r.randrange(4000)}"
    items = [(i, " ".join(word() for _ in range(r.choice([1, 3, 5, 6, 12, 40, 70])))) for i in range(40)]
    docs = []
    for d in range(200):
        w = [word() for _ in range(r.choice([0, 2, 30, 300, 2000]))]
        if d % 2:
            item = r.choice(items)[1].split()
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                item[r.randrange(len(item))] = word()
            cut = r.randrange(len(w) + 1)
            w[cut:cut] = item
        docs.append((d, " ".join(w)))
    return docs + [(900, None), (901, ""), (902, items[0][1]), (None, items[0][1])], items + [(90, None), (91, "")]


def test_equals_brute_force(spark):
    docs, items = data()
    want = sorted(
        (str(d), i, len(shingles(t) & s), len(s))
        for d, t in docs
        for i, s in ((i, shingles(q)) for i, q in items)
        if s and 5 * len(shingles(t) & s) >= 4 * len(s)
    )
    frame = spark.createDataFrame([(*d, "x", "y") for d in docs], SCHEMA)
    asked = spark.createDataFrame(items, "item_id long, text string")
    for block_bytes in (10**6, 500):
        found = find_leaks(frame.drop("item_id"), asked, block_bytes=block_bytes)
        got = sorted((str(r.doc_id), r.item_id, r.n_held, r.n_item) for r in found.collect())
        assert got == want and len(want) > 30


def test_sketch_is_never_too_short():
    for size in range(1, 3000):
        assert sketch_length(size, (4, 5)) >= min(size, size - -(-4 * size // 5) + 1)


def test_drop_and_empty_tables(spark):
    docs, items = data()
    frame = spark.createDataFrame([(*d, "x", "y") for d in docs], SCHEMA)
    asked = spark.createDataFrame(items, "item_id long, text string")
    left = drop_leaks(frame, asked)
    assert left.columns == frame.columns
    assert 902 not in {r.doc_id for r in left.collect()} and None in {r.doc_id for r in left.collect()}
    assert find_leaks(frame.limit(0), asked).collect() == [] and find_leaks(frame, asked.limit(0)).collect() == []
