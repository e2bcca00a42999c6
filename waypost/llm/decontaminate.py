"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle set. A document that holds at
least the threshold of an item's shingles misses at most ``m`` of them, so among the
``m + 1`` smallest hashes of the item (its MinHash sketch) it holds at least one;
``m`` comes from the upper size of the item's partition. The sketches are the index.
Every document looks up all its shingles, whatever its length, so a short item is
found in a long document and no true pair is missed; a candidate is then verified by
exact shingle containment, on the words themselves.

The items' distinct texts are taken in blocks of bounded size (a stated query set). A
block is all that tasks and the driver hold besides documents; more items are more passes
over the documents, each written before the next block is read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from waypost.llm.batches import in_slices
from waypost.llm.shingles import sequence_prints, word_prints, words
from waypost.workspace import release, settle

#: Words in a shingle, and the share of an item's shingles a document must hold.
SHINGLE = 5
CONTAINED = (4, 5)

#: Bytes of item texts in a block.
BLOCK_BYTES = 8_000_000


def size_partition(size: int) -> tuple[int, int]:
    """Lower and upper size of the partition (powers of two) that ``size`` lies in."""
    low = 1 << (size.bit_length() - 1)
    return low, 2 * low - 1


def sketch_length(size: int, share: tuple[int, int]) -> int:
    """Smallest hashes of an item of this size that its partition keeps.

    An item of ``u`` shingles, the partition's upper size, may lack ``u`` minus
    ``ceil(share * u)`` of them; smaller items of the partition lack no more.
    """
    upper = size_partition(size)[1]
    return min(size, upper - math.ceil(upper * share[0] / share[1]) + 1)


def _word_shingles(found: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    n = min(n, len(found))
    return {tuple(found[i : i + n]) for i in range(len(found) - n + 1)} if n else set()


class Index:
    """Sketches and shingles of a block of items."""

    def __init__(self, items: list[tuple], n: int, share: tuple[int, int]):
        self.n, self.share = n, share
        self.ids, self.shingles = [], []
        hashes, owners = [], []
        for item_id, text in items:
            found = words((text or "").encode())
            prints = np.unique(sequence_prints(word_prints(found), n))
            if len(prints):
                kept = prints[: sketch_length(len(prints), share)]
                hashes.append(kept)
                owners.append(np.full(len(kept), len(self.ids)))
                self.ids.append(item_id)
                self.shingles.append(_word_shingles(found, n))
        self.hashes = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.owners = np.concatenate(owners) if owners else np.empty(0, np.int64)
        order = np.argsort(self.hashes, kind="stable")
        self.hashes, self.owners = self.hashes[order], self.owners[order]

    def search(self, text: bytes) -> Iterator[tuple]:
        """(item id, shingles held, shingles of the item) of each item that ``text`` contains."""
        found = words(text)
        prints = np.unique(sequence_prints(word_prints(found), self.n))
        if not len(prints) or not len(self.hashes):
            return
        first = np.searchsorted(prints, self.hashes)
        hit = prints[np.minimum(first, len(prints) - 1)] == self.hashes
        if not hit.any():
            return
        own = _word_shingles(found, self.n)
        for k in np.unique(self.owners[hit]).tolist():
            held, size = len(own & self.shingles[k]), len(self.shingles[k])
            if held * self.share[1] >= size * self.share[0]:
                yield self.ids[k], held, size


def _searching(index, id_type: pa.DataType, item_type: pa.DataType):
    names = ["id", "digest", "n_held", "n_item"]
    types = [id_type, item_type, pa.int64(), pa.int64()]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (doc, *hit)
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for hit in index.value.search(text or b"")
            ]
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return search


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    n: int = SHINGLE,
    share: tuple[int, int] = CONTAINED,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The pairs of a document and an item of which it holds at least ``share``.

    Columns: the two ids under their own names (``item_`` before the item's if they
    clash), ``n_held``, ``n_item`` and ``containment``. Words are runs of anything but
    ASCII white space with A-Z in lower case; a text of fewer than ``n`` words is one
    shingle. A null or empty text has none: such items are found nowhere and such
    documents hold nothing. Rows repeated on either side repeat their pairs, null ids
    stay null, other columns are not read, and no rows on a side give no pairs.
    """
    spark = docs.sparkSession
    out_item = item_id if item_id != id_col else f"item_{item_id}"
    kind = docs.schema[id_col].dataType
    schema = f"id {kind.simpleString()}, digest string, n_held long, n_item long"
    asked = items.select(
        F.col(item_id).alias("_item"), F.sha2(F.col(item_text).cast("binary"), 256).alias("digest"), F.col(item_text).alias("text")
    ).filter("text IS NOT NULL")
    texts = asked.select("digest", "text").dropDuplicates(["digest"])
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = total // block_bytes + 1
    block = F.pmod(F.xxhash64("digest"), F.lit(n_blocks))
    source = docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("text"))
    if n_blocks > 1:
        texts = settle(texts, "items")
    parts = []
    for k in range(n_blocks):
        held = texts if n_blocks == 1 else texts.filter(block == k)
        # A block's texts are about ``block_bytes``; that much goes through the driver.
        index = spark.sparkContext.broadcast(Index([tuple(r) for r in held.collect()], n, share))
        part = source.mapInArrow(in_slices(_searching(index, to_arrow_type(kind), pa.string())), schema)
        if n_blocks > 1:
            part = settle(part, "leaks")
            index.destroy()
        parts.append(part)
    if n_blocks > 1:
        release(texts)
    found = reduce(DataFrame.unionByName, parts).join(asked.select("_item", "digest"), "digest")
    return found.select(
        F.col("id").alias(id_col),
        F.col("_item").alias(out_item),
        "n_held",
        "n_item",
        (F.col("n_held") / F.col("n_item")).alias("containment"),
    )


def drop_leaks(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows whose id is that of a document holding an item.

    Rows with a null id cannot be told apart and stay.
    """
    leaked = find_leaks(docs, items, id_col=id_col, **options).select(id_col).distinct()
    return docs.join(leaked, id_col, "left_anti")
