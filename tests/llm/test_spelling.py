"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from waypost.llm import spelling as S


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(counts, ratio=10):
    found = {w: [v for v in counts if near(w, v)] for w in counts}
    forms = {}
    for w, others in found.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = set()
    for w, form in forms.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, form, root, counts[w], len(found[w]), None if form is None else counts[form]))
    return out


def found(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("alphabet", ["ab", "aé\U0001d4b3", "abcdef"])
def test_against_all_pairs(spark, alphabet):
    rng = random.Random(len(alphabet))
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randint(0, 7))) for _ in range(250)}
    counts = {w: int(10 ** rng.uniform(0, 6)) + 1 for w in words}
    rows = [(w, n, "x", 1) for w, n in counts.items()] + [(None, 3, "x", 1), ("aaaaaaaaaa", None, "x", 1), ("zz", 0, "x", 1)]
    frame = spark.createDataFrame(rows, "word string, n long, prefix string, key int").repartition(7)
    assert found(S.spelling_variants(frame)) == brute(counts)


def test_repeated_words_chains_and_ties(spark):
    counts = {"colour": 10_000, "colou": 1000, "coou": 100, "cou": 10, "cu": 1, "colours": 10_000, "colouur": 10}
    rows = [(w, n) for w, n in counts.items() if w != "cou"] + [("cou", 4), ("cou", 6)]
    got = found(S.spelling_variants(spark.createDataFrame(rows, "word string, n long")))
    assert got == brute(counts)
    assert ("cu", "cou", "colour", 1, 1, 10) in got


def test_nodes_number_prefixes_across_partitions(spark):
    rng = random.Random(4)
    words = {"common" * 3 + "".join(rng.choice("ab") for _ in range(rng.randint(0, 9))) for _ in range(400)} | {"", "zz"}
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = S.number_nodes(frame).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r.part for r in rows}) > 10
    number = {}
    for r in rows:
        assert len(r.nodes) == len(r.word) + 1
        for k, node in enumerate(r.nodes):
            assert number.setdefault(r.word[:k], node) == node
    assert len(set(number.values())) == len(number)
    assert sorted(words) == sorted(words, key=lambda w: number[w])


def test_words_of_texts(spark):
    texts = [
        "Colour ÀÉcolour colour-x É×÷ß longword LONGWORD Longword\nlongword", None, "", "short aaaaaaa", "ſongword longwordĀlongword",
        "longword " * 50 + "Istanbul İstanbul " * 3, "x" * 300_000,
    ]
    rows = [(k * 7, t, "w", 1) for k, t in enumerate(texts * 40)] + [(None, "longword otherword", "w", 1)] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string, word string, n long").repartition(3)
    for options in ({}, {"one_in": 31}, {"one_in": 2}):
        want = Counter()
        for d, t, *_ in rows:
            for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
                run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
                h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
                if options and h % options["one_in"] == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                want[run] += 1
        want = {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}
        for held in (S.HELD_WORDS, 1):
            got = {r.word: r.n for r in S.count_words(frame, held_words=held, **options).collect()}
            assert got == want
    assert found(S.spelling_variants(S.count_words(frame, one_in=2))) == brute(want)


def test_long_words(spark):
    long = "ab" * 100_000
    counts = {long: 100, long + "c": 5, long[1:]: 7, long[:-1] + "z": 2}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {(len(r.word), r.n, r.n_near, r.form_n) for r in S.spelling_variants(frame).collect()}
    assert got == {(200_000, 100, 3, None), (200_001, 5, 1, 100), (199_999, 7, 1, 100), (200_000, 2, 1, 100)}


def test_no_rows(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert S.spelling_variants(S.count_words(frame)).collect() == []
    with pytest.raises(ValueError):
        S.spelling_variants(spark.createDataFrame([("a", 1)], "word string, n long"), ratio=1)


def test_query_matches_its_sql(spark):
    import __spark_entry__ as entry_points
    from oracle import compare, connect

    sf, query = "/root/testdata/sf0.001", "op13_spelling_variants"
    assert compare(entry_points.queries()[query](spark, sf), connect(sf), entry_points.oracle_sql()[query]) == ""
