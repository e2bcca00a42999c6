"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waypost.workspace import release, settle

#: Most nodes that are broadcast, and the fewest links of a node among them.
HOT_NODES = 10_000
HOT_LINKS = 1_000

#: Links that a task holds at once, 16 bytes each.
BLOCK_LINKS = 500_000


def smallest_reached(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ends of links, ascending, and the smallest end that each reaches."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    low = np.arange(len(nodes))
    a, b = at[: len(u)], at[len(u) :]
    while len(a):
        # A root of either end hangs below the smaller of both, then paths shrink to one step.
        np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
        while (low[low] != low).any():
            low = low[low]
        a, b = low[a], low[b]
        apart = a != b
        a, b = a[apart], b[apart]
    return nodes, nodes[low]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links with the same components, as stars: each node of a block with the smallest it reaches there."""

    def stars(u: list[np.ndarray], v: list[np.ndarray]) -> list[np.ndarray]:
        return list(smallest_reached(np.concatenate(u), np.concatenate(v)))

    u, v, held = [], [], 0
    for batch in batches:
        for s in range(0, batch.num_rows, BLOCK_LINKS):
            some = batch.slice(s, BLOCK_LINKS)
            u.append(some.column(0).to_numpy())
            v.append(some.column(1).to_numpy())
            held += some.num_rows
            if held > BLOCK_LINKS:
                node, root = stars(u, v)
                u, v, held = [node], [root], len(node)
                if held > BLOCK_LINKS // 2:
                    yield pa.record_batch([pa.array(node), pa.array(root)], ["u", "v"])
                    u, v, held = [], [], 0
    if held:
        yield pa.record_batch([pa.array(x) for x in stars(u, v)], ["u", "v"])


def _to_smallest(pairs: DataFrame, n_links: int) -> DataFrame:
    """``pairs`` (u, v) with the smallest of ``u`` and all its ``v`` as ``low``.

    The smallest is combined before the shuffle. No more than ``HOT_NODES`` nodes can each
    have more than that share of all links; what is found for these is broadcast, and only
    the links of other nodes are shuffled to meet it.
    """
    lows = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"), F.count("*").alias("n"))
    is_hot = F.col("n") > max(HOT_LINKS, 2 * n_links // HOT_NODES)
    hot = F.broadcast(lows.filter(is_hot).select("u", F.col("low").alias("hot_low")))
    placed = pairs.join(hot, "u", "left")
    cold = placed.filter("hot_low IS NULL").select("u", "v").join(lows.filter(~is_hot).drop("n"), "u")
    return cold.union(placed.filter("hot_low IS NOT NULL").select("u", "v", "hot_low"))


def _large_star(links: DataFrame, n_links: int) -> DataFrame:
    both = links.union(links.select("v", "u"))
    return _to_smallest(both, n_links).filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(links: DataFrame, n_links: int) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    starred = _to_smallest(down, n_links)
    return starred.select("v", "low").union(starred.select("u", "low")).toDF("u", "v").filter("u <> v")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it reaches, for every node of ``links``.

    ``links`` has two long columns, the ends; direction, repeats and order do not
    matter, a link to itself makes a node of its own, and links with a null are left
    out. Each task first makes stars of its own links, block by block. Where more than a
    block of them is left, rounds over all links follow, of which each halves what is
    left of the longest path and is written to the shared folder.
    """
    links = settle(links.toDF("u", "v").dropna().mapInArrow(_contract, "u long, v long"), "links")
    n_links = links.count()
    if n_links <= BLOCK_LINKS:
        found = settle(links.coalesce(1).mapInArrow(_contract, "u long, v long"), "components")
        release(links)
        return found.toDF("node", "root")
    alone = settle(links.filter("u = v").select("u").distinct(), "lone-nodes")
    started, links = links, settle(links.filter("u <> v").distinct(), "links")
    release(started)
    before, n_links = None, links.count()
    while n_links:
        stars = settle(_large_star(links, n_links), "stars")
        shorter = settle(_small_star(stars, n_links).distinct(), "links")
        release(links)
        release(stars)
        links = shorter
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    found = links.toDF("node", "root")
    roots = found.select(F.col("root").alias("node"), "root").distinct()
    known = found.union(roots)
    lone = alone.join(known.select(F.col("node").alias("u")), "u", "left_anti")
    return known.union(lone.select("u", "u"))
