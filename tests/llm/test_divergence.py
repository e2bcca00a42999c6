"""Divergence of sources against plain Python, tiles and cells cut small."""

import random
import re
from collections import Counter, defaultdict

from waypost.llm.divergence import source_divergence

COLUMNS = "doc_id long, text string, lang string, source string, value long, rank int"


def brute(rows, min_docs, top):
    docs = defaultdict(Counter)
    counts = defaultdict(Counter)
    for text, lang, source in rows:
        text, lang, source = (x or "" for x in (text, lang, source))
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        docs[lang].update(set(found))
        counts[lang, source].update(found)
    out = set()
    for lang in {g[0] for g in counts}:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        groups = {s: c for (g, s), c in counts.items() if g == lang}

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in groups if o != s]
            own = [(q[t] - p[s][t], t.encode()) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(own)[:top])):
                out |= {(lang, s, part, item.decode(), -v, r) for r, (v, item) in enumerate(found, 1)}
    return out


def found(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_rows(seed, n):
    rng = random.Random(seed)
    words = ["a", "B", "é", "É", "zz", "中文", "it's", "x1y", "ﬁ", "𝒳", "Q-q", *(f"w{chr(97 + k)}" for k in range(26))]
    pick = lambda: " ".join(rng.choice(words) for _ in range(int(rng.expovariate(0.05))))
    return [
        (rng.choice([None, "", "12 ,;", pick(), pick(), pick()]), rng.choice([None, "", "en", "en", "de"]),
         rng.choice([None, "", "s1", "s1", "s1", "s2", "Ä", "z"]))
        for _ in range(n)
    ]


def test_against_plain_python(spark):
    for seed, (band, cut, top) in enumerate([(256, 8192, 50), (2, 3, 4), (1, 1, 2)]):
        rows = random_rows(seed, 300)
        rows += [("only here " * 3, "fr", "s1")] * 2 + [(None, "it", "s1"), ("x", "it", "s2"), ("alone", "pt", None)]
        # Columns named like the operator's own are not read.
        docs = spark.createDataFrame([(k, *r, 7, 7) for k, r in enumerate(rows)], COLUMNS).repartition(5)
        got = source_divergence(docs, min_docs=5, top=top, band=band, slice_terms=cut)
        assert found(got) == brute(rows, 5, top)
        assert got.dtypes[4:] == [("value", "bigint"), ("rank", "int")]


def test_partial_counts_and_long_terms(spark):
    rows = random_rows(9, 120) + [("é" * 100_000, "en", "s1")] * 6 + [(None, "en", "s1")] * 3
    docs = spark.createDataFrame(rows, "text string, lang string, source string").coalesce(1)
    from waypost.llm import divergence as d

    whole = sorted(map(tuple, d.tally_terms(docs).collect()), key=repr)
    cut = sorted(map(tuple, d.tally_terms(docs, held_entries=1, held_bytes=50).collect()), key=repr)
    assert whole == cut
    assert found(source_divergence(docs, min_docs=6)) == brute(rows, 6, 50)


def test_ties_go_by_bytes_and_stop_at_the_last_rank(spark):
    words = [f"t{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(80)] + ["Zed", "éa", "𝒳", "ﬁ"]
    rows = [(" ".join(words), "en", "a")] * 2 + [("common", "en", "b")] * 9
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    got = found(source_divergence(docs, min_docs=2, top=50))
    assert got == brute(rows, 2, 50)
    listed = [r[3] for r in sorted(got, key=lambda r: r[5]) if r[1] == "a" and r[2] == "term"]
    assert listed == sorted((w.lower() if w == "Zed" else w for w in words), key=str.encode)[:50]


def test_large_counts_stay_exact(spark):
    from waypost.llm.divergence import _proportion

    count, total = 3 * 10**15 + 1, 10**16 + 7
    row = spark.createDataFrame([(count, total, 10**7)], "c long, t long, v long").select(_proportion("c", "t", "v")).first()
    assert row[0] == 1 + 10**9 * (count + 5) // (total + 5 * 10**7)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "text string, lang string, source string")
    assert source_divergence(docs).collect() == []


def test_query_matches_its_sql(spark):
    import __spark_entry__ as entry_points
    from oracle import compare, connect

    sf, query = "/root/testdata/sf0.001", "op11_source_divergence"
    assert compare(entry_points.queries()[query](spark, sf), connect(sf), entry_points.oracle_sql()[query]) == ""
