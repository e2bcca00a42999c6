import numpy as np
import pyarrow as pa

import waypost.llm.components as stars
from waypost.llm.components import components


def test_components_of_few_links_take_few_jobs(spark):
    """A job has as many tasks a stage as there are shuffle partitions, so rounds over few links cost more than the links."""
    path = [(k, k + 1) for k in range(300)] + [(400, 400), (901, 900), (902, 901)]
    context = spark.sparkContext
    context.setJobGroup("few-links", "components of a long path")
    try:
        got = {n: root for n, root in components(spark.createDataFrame(path, "a long, b long")).collect()}
    finally:
        context._jsc.sc().clearJobGroup()
    assert got == dict.fromkeys(range(301), 0) | {400: 400} | dict.fromkeys((900, 901, 902), 900)
    assert len(context.statusTracker().getJobIdsForGroup("few-links")) <= 6


def test_components_of_many_links_take_rounds(spark, monkeypatch):
    monkeypatch.setattr("waypost.llm.components.BLOCK_LINKS", 2)
    rng = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))] + [(500, 500), (3, 3)]
    low = {n: n for link in links for n in link}
    for _ in low:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    found = components(spark.createDataFrame(links, "a long, b long").repartition(3))
    assert sorted(map(tuple, found.collect())) == sorted(low.items())


def test_blocks_of_links_keep_their_components(monkeypatch):
    monkeypatch.setattr(stars, "BLOCK_LINKS", 7)
    rng = np.random.default_rng(6)
    u, v = rng.integers(0, 60, (2, 100))
    batches = [pa.record_batch([pa.array(u[k : k + 30]), pa.array(v[k : k + 30])], ["u", "v"]) for k in range(0, 100, 30)]
    made = pa.Table.from_batches(stars._contract(iter(batches)))
    again = stars.smallest_reached(made["u"].to_numpy(), made["v"].to_numpy())
    assert all((x == y).all() for x, y in zip(again, stars.smallest_reached(u, v)))
