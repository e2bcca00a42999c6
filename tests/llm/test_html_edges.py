"""Pages' texts against brute force over the whole sorted list, wherever partitions end."""

import random

import pytest
from pyspark.sql import functions as F

from waypost.llm import html_text
from waypost.llm.html_text import _same_start, extract_text, lines, main_text

SCHEMA = "page_id long, url string, html string"


def brute_force(spark, rows):
    """By the definition, in one list: the nearest page beyond a page's copies, by path."""
    keyed = spark.createDataFrame(rows, SCHEMA).select("page_id", F.xxhash64("page_id", "url").alias("print"))
    prints = {r.page_id: r.print for r in keyed.collect()}
    pages = []
    for page_id, url, page in rows:
        host, _, path = url.split("//")[1].partition("/")
        pages.append((host, "/" + path.split("?")[0], page_id, url, lines(page)))
    pages.sort(key=lambda p: (p[0], p[1], prints[p[2]]))
    body = [[x for x in p[4] if not x.framed] for p in pages]
    out = []
    for k, (host, path, page_id, url, _) in enumerate(pages):
        near = []
        for step in (-1, 1):
            j = k
            while 0 <= j < len(pages) and pages[j][0] == host and body[j] == body[k]:
                j += step
            if 0 <= j < len(pages) and pages[j][0] == host:
                near.append(pages[j])
        best = max(near, key=lambda p: _same_start(p[1], path), default=None)
        out.append((page_id, url, main_text(body[k], best and [x.text for x in best[4]])))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    """Sites without articles, with runs of copies longer than a partition."""
    rng = random.Random(3)
    made = []
    for page_id in range(600):
        host = rng.choice(["a.org", "b.org", "b.org", "b.org", f"h{page_id}.org"])
        kind = rng.choice(["x", "x", "y", "z"])
        text = "Same text" if kind == "x" else f"Text {rng.randrange(40)}"
        frame = [f"<p>Menu {rng.randrange(2)}</p>", f"<nav><p>Go {rng.randrange(2)}</p></nav>"]
        page = frame[0] + frame[1] + f"<p>{text}</p><p>Imprint {host}</p>"
        made.append((page_id, f"http://{host}/{kind}/{rng.randrange(30)}?p={page_id}", page))
    return made


@pytest.mark.parametrize("parts", [1, 7, 211])
def test_any_partitioning_gives_brute_force_texts(spark, rows, parts, monkeypatch):
    monkeypatch.setattr(html_text, "PARTITION_PAGES", 1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
        got = sorted((r.page_id, r.url, r.text) for r in extract_text(frame).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute_force(spark, rows)


def test_some_lines_are_decided_by_the_neighbour(spark, rows):
    alone = {page_id: main_text(lines(page), None) for page_id, _, page in rows}
    assert sum(text != alone[page_id] for page_id, _, text in brute_force(spark, rows)) > len(rows) / 2
