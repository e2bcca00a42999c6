"""N-gram Jaccard join as a blocked sparse matrix product.

Documents are rows and word n-grams columns of an incidence matrix X; the overlaps of
all pairs are X times its transpose. Sizes keep that product small:

* Copies. Documents with the same set are one row.
* Blocks. Sets of a and b n-grams that are similar enough differ in at most H of them,
  H from a + b alone. The n-gram space is cut into more than H ranges, so two such sets
  agree on a whole range, and the print of a set's part in a range is a key they share.
  Sizes are taken in classes, since H and the ranges depend on them; a document takes
  part in its own class and the one below. With more ranges than H + 1 they agree on more
  than one, so a row that shares fewer keys than that with all others together is similar
  to none and leaves: documents that merely share a passage go here. Rows that share keys
  are linked into families, by one link to the smallest row of each key, never all pairs.
  A row leaves out its links to the rows that most others link to, as long as what is left
  out is too little for a similar row: passages that very many share join no families.
* Product. Within a family the product is accumulated row by row over the live columns,
  and pairs below the bound of their sizes are discarded. A large family is cut into
  tiles and each pair of tiles is a task of bounded size. Of the links a task finds it
  returns a forest, since only reachability is asked for.

Keys and sets travel as packed arrays in blocks of bounded size. A key that many rows
of a map task have leaves it once. Until sets are compared, keys and rows go by the first
bits of their prints: what coincides by that is compared for nothing, never left out.
Sets are gathered and multiplied in rounds that each hold a share of the texts' size.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waypost.llm.batches import in_slices
from waypost.llm.components import components
from waypost.llm.shingles import mix, shingle_set
from waypost.workspace import release, settle, sweep

#: Keys in a block, and in a map task's memory before they are sent.
BLOCK_KEYS = 1_000_000
SENT_KEYS = 400_000

#: N-grams of the rows in a tile of a family, and of the small families in a task.
TILE_GRAMS = 500_000

#: N-grams that a round gathers, and deals to tasks at once: for each byte of text, and at least.
ROUND_SHARE = 1 / 40
ROUND_GRAMS = 10_000_000

#: Bytes of a key's print that are sent; most rows of a flush that are sent with a key, which is a node itself beyond.
KEY_BYTES = 6
KEY_ROWS = 64

#: Words of 64 bits in a bitmap of ids that is broadcast.
FILTER_WORDS = 1 << 18

#: Most classes of equal sets whose results are broadcast.
HOT_CLASSES = 10_000

#: Keys for each byte of text, about; only sizes the blocks.
KEYS_PER_BYTE = 0.06


class Sizes:
    """What the threshold p/q says about set sizes."""

    def __init__(self, share: tuple[int, int]):
        self.p, self.q = share
        self.lows = [1]

    def size_class(self, n: int) -> int:
        """Classes are such that a similar, larger set is in the same or the next one."""
        while self.lows[-1] <= n:
            self.lows.append(self.lows[-1] * self.q // self.p + 1)
        return bisect.bisect_right(self.lows, n) - 1

    def ranges(self, k: int) -> tuple[int, int]:
        """(H, ranges) for pairs whose smaller set is in class ``k``.

        Similar sets agree on at least ranges - H parts, some of which may be empty.
        """
        while len(self.lows) < k + 2:
            self.lows.append(self.lows[-1] * self.q // self.p + 1)
        a = self.lows[k + 1] - 1
        h = (self.q - self.p) * (a + a * self.q // self.p) // (self.q + self.p)
        return h, h + 1 + h // 8

    def similar(self, overlap: np.ndarray, a: int, b: np.ndarray) -> np.ndarray:
        return self.q * overlap >= self.p * (a + b - overlap)


def set_keys(grams: np.ndarray, sizes: Sizes) -> tuple[np.ndarray, int]:
    """The keys of a sorted set, and how many of them any similar, different set shares at least.

    Empty parts are keys only if they alone could be what two sets agree on.
    """
    own = sizes.size_class(len(grams))
    spread = mix(grams)
    found, shared = [], []
    for k in (own - 1, own):
        h, n_ranges = sizes.ranges(k) if k >= 0 else (0, 0)
        if not h:
            continue  # only equal sets are similar
        at = ((grams >> np.uint64(32)) * np.uint64(n_ranges)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        parts = at[first]
        label = np.uint64(k + 1) << np.uint64(32)
        found.append(mix(np.add.reduceat(spread, first) ^ mix(label | parts)))
        n_empty = n_ranges - len(parts)
        shared.append(n_ranges - h - n_empty)
        if shared[-1] <= 0:
            empty = np.setdiff1d(np.arange(n_ranges, dtype=np.uint64), parts, assume_unique=True)
            found.append(mix(mix(label | empty)))
    return (np.concatenate(found) if found else np.empty(0, np.uint64)), max(1, min(shared, default=1))


def set_prints(grams: np.ndarray) -> tuple[int, int]:
    """Two 64-bit prints that together stand for a set."""
    high, low = divmod(xxhash.xxh3_128_intdigest(grams.tobytes()), 1 << 64)
    return high - (1 << 63), low - (1 << 63)


def _codes(prints: np.ndarray) -> np.ndarray:
    """What rows go by in links: 32 bits of their set's print, as signed integers."""
    return ((prints & 0xFFFFFFFF) - (1 << 31)).astype(np.int32)


#: The same in Spark.
_CODE = "cast((cls & 4294967295L) - 2147483648L as int)"


def _packed(keys: np.ndarray) -> bytes:
    """The first bytes of sorted keys, each byte by itself: the first of them hardly change."""
    return np.ascontiguousarray(keys.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].T).tobytes()


def _unpacked(sent: bytes) -> np.ndarray:
    planes = np.frombuffer(sent, np.uint8).reshape(KEY_BYTES, -1)
    keys = np.zeros((planes.shape[1], 8), np.uint8)
    keys[:, :KEY_BYTES] = planes.T
    return keys.view(">u8").ravel().astype(np.uint64)


def _counted_pairs(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct pairs with the sum of ``n``."""
    order = np.lexsort((b, a))
    a, b, n = a[order], b[order], n[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.flatnonzero(new)
    return a[first], b[first], np.add.reduceat(n, first) if len(first) else n


def _stars(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys with their smallest owner, and links from other owners to it with their keys' number.

    An owner that is there several times with a key counts once.
    """
    if not len(keys):
        return keys, owners, owners, owners, owners
    order = np.lexsort((owners, keys))
    keys, owners = keys[order], owners[order]
    new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])))
    keys, owners = keys[new], owners[new]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    low = owners[first]
    lows = np.repeat(low, np.diff(np.append(first, len(keys))))
    other = owners != lows
    ones = np.ones(int(other.sum()), np.int64)
    return (keys[first], low, *_counted_pairs(owners[other], lows[other], ones))


_SENT = "block int, kind int, a binary, b binary, c binary, d binary, e binary"
_KEYS, _DOCS, _LINKS, _COMMON = 0, 1, 2, 3


def _key_links(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, ...]:
    """Links of owners to their keys as nodes."""
    return _counted_pairs(owners, _codes(mix(keys).view(np.int64)), np.ones(len(keys), np.int64))


def _sending(n: int, share: tuple[int, int], n_blocks: int):
    def rows(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
        names = ["block", "kind", "a", "b", "c", "d", "e"]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found), kinds)], names)

    def flush(docs: list[tuple], keys: list[np.ndarray], owners: list[int]) -> pa.RecordBatch:
        columns = [np.array(c, np.int64) for c in zip(*docs)]
        any_block = int(columns[0][0] % n_blocks)
        out = [(any_block, _DOCS, *(c.tobytes() for c in columns))]
        if keys:
            owner = np.repeat(_codes(np.array(owners, np.int64)), [len(k) for k in keys])
            key = np.concatenate(keys) & ~np.uint64((1 << (64 - 8 * KEY_BYTES)) - 1)
            order = np.lexsort((owner, key))
            key, owner = key[order], owner[order]
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            many = np.diff(np.append(first, len(key)))
            common = np.repeat(many > KEY_ROWS, many)
            if common.any():
                a, b, n = _key_links(key[common], owner[common])
                out.append((any_block, _LINKS, a.tobytes(), b.tobytes(), n.tobytes(), None, None))
            for kind, held, its in ((_COMMON, key[first[many > KEY_ROWS]], None), (_KEYS, key[~common], owner[~common])):
                block = ((held >> np.uint64(32)) * np.uint64(n_blocks)) >> np.uint64(32)  # keys are sorted
                edges = np.searchsorted(block, np.arange(n_blocks + 1, dtype=np.uint64))
                for k in range(n_blocks):
                    s, e = edges[k], edges[k + 1]
                    if s < e:
                        sent = None if its is None else its[s:e].tobytes()
                        out.append((k, kind, _packed(held[s:e]), sent, None, None, None))
        return rows(out)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(share)
        docs, keys, owners, held = [], [], [], 0
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams = shingle_set(text or b"", n)
                high, low = set_prints(grams)
                found, shared = set_keys(grams, sizes) if len(grams) else (None, 1)
                docs.append((doc, len(grams), high, low, shared))
                if len(grams) and (high, low) not in seen:
                    seen.add((high, low))
                    keys.append(found)
                    owners.append(high)
                    held += len(found)
                if held > SENT_KEYS or len(docs) > 200_000:
                    yield flush(docs, keys, owners)
                    docs, keys, owners, held = [], [], [], 0
                    seen.clear()
        if docs:
            yield flush(docs, keys, owners)

    return send


_MET = "id long, n_shingles long, cls long, chk long, shared long, code int, pivot int"


def _meet(sent: pa.Table) -> pa.Table:
    """The documents of a block as rows, and the links its keys make between codes.

    ``shared`` is how many keys a document must share, or how many a link stands for.
    """

    def held(kind: int, column: str) -> list[bytes]:
        return sent.filter(pc.equal(sent["kind"], kind))[column].to_pylist()

    def joined(kind: int, column: str, dtype) -> np.ndarray:
        return np.frombuffer(b"".join(held(kind, column)), dtype)

    ids, sizes, prints, checks, shared = (joined(_DOCS, c, np.int64) for c in "abcde")
    a, b, n = (joined(_LINKS, c, t) for c, t in (("a", np.int32), ("b", np.int32), ("c", np.int64)))
    keys, common = (
        np.concatenate([np.empty(0, np.uint64), *map(_unpacked, held(kind, "a"))]) for kind in (_KEYS, _COMMON)
    )
    owners = joined(_KEYS, "b", np.int32)
    is_common = np.isin(keys, common)
    met = _stars(keys[~is_common], owners[~is_common])[2:], _key_links(keys[is_common], owners[is_common])
    a, b, n = _counted_pairs(*(np.concatenate(x) for x in zip((a, b, n), *met)))
    none, no_code = pa.nulls(len(a), pa.int64()), pa.nulls(len(ids), pa.int32())
    columns = [
        pa.chunked_array([pa.array(ids), none]),
        pa.chunked_array([pa.array(sizes), none]),
        pa.chunked_array([pa.array(prints), none]),
        pa.chunked_array([pa.array(checks), none]),
        pa.chunked_array([pa.array(shared), pa.array(n)]),
        pa.chunked_array([no_code, pa.array(a)]),
        pa.chunked_array([no_code, pa.array(b)]),
    ]
    return pa.table(columns, names=[x.split()[0] for x in _MET.split(", ")])


_SETS = "family long, id long, n int, grams binary"


def _gathering(n: int):
    """Sets of the documents that are asked for; a row of another set with that id goes."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _SETS.split(", ")]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                grams = shingle_set(row["text"] or b"", n)
                if set_prints(grams) == (row["cls"], row["chk"]):
                    out.append((row["family"], row["id"], len(grams), grams.tobytes()))
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return gather


def product_links(sets: list[np.ndarray], tile: np.ndarray, sizes: Sizes) -> Iterator[tuple[int, int]]:
    """Pairs of similar rows, as positions: within one tile, or across if there are two."""
    n_rows = len(sets)
    size = np.array([len(s) for s in sets])
    grams = np.concatenate(sets)
    row = np.repeat(np.arange(n_rows), size)
    order = np.argsort(grams, kind="stable")
    grams, row = grams[order], row[order]
    first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    count = np.diff(np.append(first, len(grams)))
    column = np.repeat(np.arange(len(first)), count)
    live = count[column] > 1
    by_row = np.argsort(row[live], kind="stable")
    columns = column[live][by_row]
    edges = np.searchsorted(row[live][by_row], np.arange(n_rows + 1))
    two = tile.min() != tile.max()
    for i in range(n_rows - 1):
        held = columns[edges[i] : edges[i + 1]]
        if sizes.q * len(held) < sizes.p * size[i]:
            continue  # too few columns that any other row has
        counts = count[held]
        at = np.repeat(first[held] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
        overlap = np.bincount(row[at], minlength=n_rows)[i + 1 :]
        linked = sizes.similar(overlap, size[i], size[i + 1 :])
        if two:
            linked &= tile[i + 1 :] != tile[i]
        for j in np.flatnonzero(linked).tolist():
            yield i, i + 1 + j


def _multiplying(share: tuple[int, int]):
    def multiply(group: pa.Table) -> pa.Table:
        sizes = Sizes(share)
        group = group.sort_by("family")
        family = group["family"].to_numpy()
        ids = group["id"].to_numpy()
        tile = group["tile"].to_numpy()
        sets = [np.frombuffer(g, np.uint64) for g in group["grams"].to_pylist()]
        cuts = np.flatnonzero(np.concatenate(([True], family[1:] != family[:-1], [True])))
        a, b = [], []
        for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            parent = list(range(e - s))

            def root(x):
                while parent[x] != x:
                    parent[x] = x = parent[parent[x]]
                return x

            for i, j in product_links(sets[s:e], tile[s:e], sizes):
                x, y = root(i), root(j)
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    a.append(ids[s + i])
                    b.append(ids[s + j])
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["u", "v"])

    return multiply


def _slotted(frame: DataFrame, id_col: str) -> DataFrame:
    """With the place of the hashed id in a bitmap of ``FILTER_WORDS``."""
    slot = F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(FILTER_WORDS * 64).cast("bigint"))
    bit = F.expr("shiftleft(1L, cast(_slot % 64 AS int))")
    return frame.withColumn("_slot", slot).withColumns({"_word": F.shiftright("_slot", 6), "_bit": bit})


def _likely(rows: DataFrame, members: DataFrame) -> DataFrame:
    """The rows whose ``id`` may be a member's: a bitmap of hashed member ids is broadcast.

    ``FILTER_WORDS`` bounds the bitmap. No member is lost; how few others pass depends on
    how many members there are.
    """
    words = _slotted(members.select("id"), "id").groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    held = _slotted(rows, "id").join(F.broadcast(settle(words, "member-bits")), "_word")
    return held.where(F.col("_bits").bitwiseAND(F.col("_bit")) != 0).select(*rows.columns)


def _without(docs: DataFrame, id_col: str, judged: DataFrame) -> DataFrame:
    """``docs`` without those that are ``gone`` in ``judged`` (id, gone), which has every id that is not null.

    Two bitmaps are broadcast, of ids that go and of ids that stay; only rows that may be
    either are shuffled.
    """
    bits = {c: F.bit_or(F.when(F.col("gone") == flag, F.col("_bit")).otherwise(0)) for c, flag in (("_go", True), ("_stay", False))}
    words = _slotted(judged, "id").groupBy("_word").agg(*[x.alias(c) for c, x in bits.items()])
    marked = _slotted(docs, id_col).join(F.broadcast(settle(words, "judged-bits")), "_word", "left")
    may = {c: F.coalesce(F.col(c).bitwiseAND(F.col("_bit")) != 0, F.lit(False)) for c in bits}
    nameless = F.col(id_col).isNull()
    sure = marked.where(nameless | ~may["_go"]).select(*docs.columns)
    open_ = marked.where(~nameless & may["_go"] & may["_stay"]).select(*docs.columns)
    gone = judged.where("gone").select(F.col("id").alias("_gone_id"))
    return sure.union(open_.join(gone, F.col(id_col) == F.col("_gone_id"), "left_anti"))


def _telling(links: DataFrame, enough: DataFrame) -> DataFrame:
    """Links (code, pivot) of the rows that have enough, such that similar rows still have a pivot in common.

    Similar rows share ``need`` keys, so each may leave out pivots that stand for fewer
    together, if all rows leave out the same ones first: those with most links. A row's
    own keys count as many, so it stays a pivot for itself.
    """
    near = links.join(enough, "code")
    many = near.groupBy("pivot").agg(F.count(F.lit(1)).alias("many"))
    own = enough.join(many, F.col("code") == F.col("pivot")).select("code", "pivot", F.lit(1 << 40).alias("keys"), "need", "many")
    all_ = near.join(many, "pivot").select("code", "pivot", "keys", "need", "many").union(own)
    order = Window.partitionBy("code").orderBy(F.desc("many"), "pivot").rowsBetween(Window.unboundedPreceding, 0)
    told = all_.withColumn("keys", F.sum("keys").over(order)).filter("keys >= need")
    return told.select(F.col("code").cast("long").alias("u"), F.col("pivot").cast("long").alias("v"))


def _products(source: DataFrame, members: DataFrame, n: int, share: tuple[int, int], round_grams: int) -> list[DataFrame]:
    """Tables of links between members that are similar, a forest for each task of the product.

    Families go in rounds, as the sets of all together may be several times as large as
    the texts; a round gathers ``round_grams`` and what a family has beyond that, and
    deals about as many to its tasks at once.
    """
    spark = source.sparkSession
    grams = members.agg(F.sum("n")).first()[0] or 0
    n_rounds = max(1, -(-grams // round_grams))
    # Written, so that the join's hot families can be split.
    tiles = members.groupBy("family").agg(F.sum("n").alias("grams"), F.ceil(F.sum("n") / F.lit(TILE_GRAMS)).cast("int").alias("tiles"))
    tiles = settle(tiles.withColumn("round", F.pmod(F.xxhash64("family"), F.lit(n_rounds)).cast("int")), "tiles")
    sums = tiles.groupBy("round").agg(F.sum("grams").alias("grams"), F.sum(F.col("grams") * F.col("tiles")).alias("dealt"))
    out = []
    for k, held, dealt_grams in sorted(map(tuple, sums.collect())):
        of_round = tiles.filter(F.col("round") == k).select("family", "tiles")
        some = members.join(of_round.select("family"), "family", "left_semi") if n_rounds > 1 else members
        some = settle(some, "round-members")
        # Texts are shuffled for members only, and the few that the bitmap takes for members.
        sets = settle(_likely(source, some).join(some, "id").mapInArrow(in_slices(_gathering(n)), _SETS), "sets")
        release(some)
        sweep(spark)
        n_small = int(held // TILE_GRAMS) + 1
        n_deals = max(1, -(-dealt_grams // round_grams))
        with_tile = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
        placed = sets.join(of_round, "family").withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
        dealt = placed.withColumn("other", with_tile).select(
            F.when(F.col("tiles") > 1, F.col("family")).otherwise(F.pmod(F.xxhash64("family"), F.lit(n_small))).alias("task"),
            (F.col("tiles") > 1).alias("cut"),
            F.least("tile", "other").alias("i"),
            F.greatest("tile", "other").alias("j"),
            "family",
            "tile",
            "id",
            "grams",
        )
        for deal in range(n_deals):
            now = dealt.filter(F.pmod(F.xxhash64("task", "i", "j"), F.lit(n_deals)) == deal) if n_deals > 1 else dealt
            links = now.groupBy("task", "cut", "i", "j").applyInArrow(_multiplying(share), "u long, v long")
            # Written, as a second function in the product's stage takes a second Python worker for each task.
            out.append(settle(links, "product-links"))
            sweep(spark)
        release(sets)
    release(tiles)
    return out or [source.sparkSession.createDataFrame([], "u long, v long")]


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    n: int = 5,
    share: tuple[int, int] = (80, 100),
) -> DataFrame:
    """Per row of ``docs`` its id, ``n_shingles`` and ``component_id``.

    Words are runs of anything but ASCII white space, A-Z in lower case; a document's
    set is its distinct ``n``-word shingles, or the whole sequence as one if it has
    fewer words. Two documents link when 100 times their overlap is at least
    ``share[0]`` times their union (for ``share[1]`` = 100); a component is what links
    reach, named by its smallest id. Null or empty texts have no shingles and no
    links. Ids are integers; rows with a null id are in no component (null). Rows that
    share an id are one document with the links of all of them. Other columns are not
    read, and no rows give no rows. Shingles are compared by 64-bit prints and equal
    sets by 128-bit prints.
    """
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    source = named.filter("id IS NOT NULL")
    n_bytes = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = int(n_bytes * KEYS_PER_BYTE) // BLOCK_KEYS + 1
    sent = source.mapInArrow(in_slices(_sending(n, share, n_blocks)), _SENT)
    met = settle(sent.groupBy("block").applyInArrow(_meet, _MET), "keys-met")
    sweep(docs.sparkSession)
    rows = met.filter("pivot IS NULL").drop("code", "pivot")
    links = met.filter("pivot IS NOT NULL").groupBy("code", "pivot").agg(F.sum("shared").alias("keys"))
    links = settle(links, "key-links")

    classes = settle(
        rows.filter("n_shingles > 0")
        .groupBy("cls", "chk")
        .agg(
            F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("shared").alias("shared"), F.count("*").alias("many")
        )
        .withColumn("code", F.expr(_CODE)),
        "set-classes",
    )
    # No less than the keys a class shares: those of its links, to it and from it.
    both = links.select("code", "keys").union(links.select("pivot", "keys"))
    need = classes.groupBy("code").agg(F.min("shared").alias("need"))
    enough = both.groupBy("code").agg(F.sum("keys").alias("keys")).join(need, "code").filter("keys >= need").select("code", "need")
    enough = settle(enough, "classes-with-keys")
    near = settle(_telling(links, enough), "near-links")
    release(links)
    families = settle(components(near).select(F.col("node").cast("int"), F.col("root")), "families")
    release(near)

    # Different sets with one code are a family too.
    shared = classes.groupBy("code").count().filter("count > 1").select("code")
    stay = enough.select("code").union(shared).distinct()
    placed = classes.join(stay, "code").join(families.toDF("code", "family"), "code", "left")
    placed = settle(placed.withColumn("family", F.coalesce("family", F.col("code").cast("long"))), "placed")
    several = placed.groupBy("family").count().filter("count > 1").select("family")
    members = settle(placed.join(several, "family", "left_semi"), "family-members")
    for table in (families, enough, placed):
        release(table)
    sweep(docs.sparkSession)
    links = _products(source, members, n, share, max(ROUND_GRAMS, int(n_bytes * ROUND_SHARE)))
    roots = settle(components(reduce(DataFrame.union, links)), "roots")
    for table in (members, *links):
        release(table)
    found = classes.join(roots.toDF("id", "root"), "id", "left").select(
        "cls", "chk", "many", F.coalesce("root", "id").alias("component_id")
    )
    found = settle(found, "class-components")
    release(classes)
    release(roots)
    sweep(docs.sparkSession)
    # Classes of many rows are few and broadcast; the rows of others are shuffled to meet theirs.
    n_rows = found.agg(F.sum("many")).first()[0] or 0
    is_hot = F.col("many") > max(2, n_rows // HOT_CLASSES)
    hot = found.filter(is_hot).select("cls", "chk", F.col("component_id").alias("hot"))
    placed = rows.join(F.broadcast(hot), ["cls", "chk"], "left")
    small = found.filter(~is_hot).drop("many")
    cold = placed.filter("hot IS NULL").drop("hot").join(small, ["cls", "chk"], "left")
    warm = placed.filter("hot IS NOT NULL").withColumnRenamed("hot", "component_id")
    nameless = named.filter("id IS NULL").mapInArrow(_sizing(n), "n_shingles long")
    return (
        cold.unionByName(warm)
        .select("id", "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
        .union(nameless.select(F.lit(None).cast("long"), "n_shingles", F.lit(None).cast("long")))
        .withColumnRenamed("id", id_col)
    )


def _sizing(n: int):
    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [len(shingle_set(t or b"", n)) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([pa.array(found, pa.int64())], ["n_shingles"])

    return size


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id.

    Rows with a null id stay.
    """
    found = jaccard_components(docs, id_col, text_col, **options).filter(F.col(id_col).isNotNull())
    # Of rows that share an id all have its component.
    judged = found.select(F.col(id_col).alias("id"), (F.col(id_col) != F.col("component_id")).alias("gone")).distinct()
    judged = settle(judged, "judged")
    sweep(docs.sparkSession)
    return _without(docs, id_col, judged)
