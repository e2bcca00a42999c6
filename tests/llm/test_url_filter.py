"""URL verdicts against plain Python, rules and models alike."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from waypost.llm.queries import URL_RULES
from waypost.llm.url_filter import STEP, judge_urls, keep_allowed

URLS = [
    None, "", "no scheme", "://", "http://", "http://COM/", "http://com", "http://com?x=/", "http://.com/",
    "http://a.Example.COM/en/x", "http://www.example.com/en/", "http://wwww.example.com/en/", "http://a.www.example.com/en/1?u=://b/",
    "http://example.com/EN/", "http://x.net/es/1", "http://net/fr/", "http://x.net:80/fr/", "http://ÀÉ.com/é#", "http://x.net/\n/es/",
    "http://user@b.com/\U0001d4b3", "mailto://x.net/es/?a=://y.com/", "a.b.c.d.e.f.com/x", "ftp://a.b.c.d.e.f.com/x", "http://xnet/es/",
]


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url)
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def ruled(host, path, rules):
    fitting = [
        (len(h + p), len(h), p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fitting:
        return None, None
    size, deep, p, v = max(fitting)
    return host[len(host) - deep :] + p, v


def brute(rows, rules, order=4, folds=5):
    urls = [u or "" for _, u in rows]
    at = [parts(u) for u in urls]
    found = [ruled(*a, rules) for a in at]
    held = [int(hashlib.md5(u.encode()).hexdigest()[:8], 16) % folds == 0 for u in urls]
    padded = ["\x02" * order + u + "\x03" for u in urls]
    grams = [[g[i : i + order + 1] for i in range(len(g) - order)] for g in padded]
    counts = {k: defaultdict(Counter) for k in ("allow", "block")}
    alphabet = {g[-1] for gs in grams for g in gs}
    for gs, (_, v), h in zip(grams, found, held):
        for g in gs if v and not h else []:
            for k in range(order + 1):
                counts[v][g[k:-1]][g[-1]] += 1

    def chance(kind, context, c, longest):
        p = 1.0 / max(len(alphabet), 1)
        for k in range(longest, -1, -1):
            seen = counts[kind].get(context[k:], {})
            total, many = sum(seen.values()), len(seen)
            p = (seen.get(c, 0) + many * p) / (total + many) if total else p
        return p

    def weight(g):
        x = (math.log(chance("allow", g[:-1], g[-1], order)) - math.log(chance("block", g[:-1], g[-1], order))) / 1e-6
        return int(math.copysign(math.floor(abs(x) + 0.5), x))

    cache = {g: weight(g) for gs in grams for g in gs}
    means = [math.floor(sum(cache[g] for g in gs) / len(gs)) for gs in grams]
    bins = [(m // STEP, v) for m, (_, v), h in zip(means, found, held) if h and v]
    n = Counter(v for _, v in bins)
    threshold = 0
    if n["allow"] and n["block"]:
        gain = lambda b: sum((n["block"] if v == "allow" else -n["allow"]) for x, v in bins if x >= b)
        steps = sorted({b for b, _ in bins})
        cuts = [(gain(b), (b + (steps[k - 1] + 1 if k else b)) * STEP // 2) for k, b in enumerate(steps)]
        threshold = min(cuts, key=lambda x: (-x[0], abs(x[1]), -x[1]))[1]
    return [
        (i, *a, r, v or ("allow" if m >= threshold else "block"), m, threshold)
        for (i, _), a, (r, v), m in zip(rows, at, found, means)
    ]


def random_urls(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeÉ-") for _ in range(rng.randint(1, 6)))
    return [
        f"http://{rng.choice(['', 'www.', word() + '.'])}{rng.choice(['example.com', word() + '.net', word() + '.org', word() + '.com'])}"
        f"/{rng.choice(['en', 'es', 'fr', word()])}/{word()}{rng.choice(['', '?q', '#z'])}"
        for _ in range(n)
    ]


def order_of(row):
    return repr(row)


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}])
def test_against_plain_python(spark, limits):
    urls = URLS + random_urls(1, 250) + ["http://hot.example.com/en/1"] * 120
    rows = [(k if k % 50 else None, u) for k, u in enumerate(urls)]
    # Columns named like the operator's own are not read.
    frame = spark.createDataFrame([(*r, "h", "p", 1, "g") for r in rows], "page_id long, url string, host string, path string, row int, gram string")
    got = judge_urls(frame.repartition(3), URL_RULES, **limits)
    assert sorted(map(tuple, got.collect()), key=order_of) == sorted(brute(rows, URL_RULES), key=order_of)


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    plan = judge_urls(frame, URL_RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_many_rules_by_shuffle(spark):
    rng = random.Random(3)
    names = ["com", "a.com", "b.a.com", "c.b.a.com", "net", "x.net"]
    rules = [(rng.choice(names), "/" + "x" * k, rng.choice(["allow", "block"])) for k in range(40)]
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    rows = [(k, f"s://{rng.choice(['', 'c.', 'd.c.'])}{rng.choice(names)}/{'x' * rng.randint(0, 45)}") for k in range(200)]
    frame = spark.createDataFrame(rows, "page_id long, url string")
    table = spark.createDataFrame([*rules, (None, "/", "block"), ("com", None, "block")], "host string, path string, verdict string")
    want = {(i, r, v) for i, _, _, r, v, _, _ in brute(rows, rules) if r}
    got = judge_urls(frame, table).filter("rule IS NOT NULL").select("page_id", "rule", "verdict")
    assert {tuple(r) for r in got.collect()} == want and len(want) > 150


def test_the_models_tell_held_out_urls_apart(spark):
    rng = random.Random(5)
    good = [f"http://{rng.choice(['news', 'river', 'garden'])}{rng.randint(1, 99)}.com/{rng.randint(1, 9)}" for _ in range(200)]
    bad = [f"http://{rng.choice(['casino', 'cheap', 'bets'])}{rng.randint(1, 99)}.net/{rng.randint(1, 9)}" for _ in range(200)]
    other = ["http://river7.org/3", "http://casino8.org/4"]
    rules = [("com", "/", "allow"), ("net", "/", "block")]
    frame = spark.createDataFrame(list(enumerate(good + bad + other)), "page_id long, url string")
    assert {r.verdict for r in judge_urls(frame, rules).filter("page_id = 400").collect()} == {"allow"}
    assert {r.verdict for r in judge_urls(frame, rules).filter("page_id = 401").collect()} == {"block"}


def test_one_kind_of_example_or_none(spark):
    rows = list(enumerate(["http://a.com/", "http://b.org/", None]))
    frame = spark.createDataFrame(rows, "page_id long, url string")
    for rules in ([("com", "/", "allow")], [("none", "/", "block")]):
        got = sorted(map(tuple, judge_urls(frame, rules).collect()))
        assert got == sorted(brute(rows, rules)) and {r[-1] for r in got} == {0}


def test_no_rows_and_long_urls(spark):
    frame = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(frame, URL_RULES).collect() == []
    rows = [(1, "http://a.com/" + "é" * 200_000), (2, "http://b.net/es/" + "." * 100_000), (3, "." * 100_000 + "://" + "a." * 50_000 + "com/")]
    frame = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r for r in judge_urls(frame, URL_RULES).collect()}
    assert [got[k].rule for k in (1, 2, 3)] == ["com/", "net/es/", "com/"]


def test_filter_keeps_rows_as_they_are(spark):
    rows = [(1, "http://a.com/", "x"), (1, "http://a.com/", "x"), (2, "http://b.net/es/", "y"), (None, None, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, _waypost string")
    assert sorted(map(tuple, keep_allowed(frame, URL_RULES).collect()), key=repr) == sorted([rows[0], rows[1], rows[3]], key=repr)


def test_query_matches_its_sql(spark):
    import __spark_entry__ as entry_points
    from oracle import compare, connect

    sf, query = "/root/testdata/sf0.001", "op12_url_filter"
    assert compare(entry_points.queries()[query](spark, sf), connect(sf), entry_points.oracle_sql()[query]) == ""
