"""How far each source of a language is from the others, and in which words.

Terms are counted per language and source inside the map tasks, so a word that a third
of all texts repeat crosses the shuffle once per task and source. The terms a language
keeps then fall into cells: terms with the same counts in the group and in the language
have the same difference, so each cell is evaluated once, cells of equal value are
merged, and ranks follow from the cells' numbers of terms. Only cells that reach the
asked ranks are expanded into terms, in the order of their bytes, and no more terms of
a cell than there are ranks.

Sums between two sources are taken on tiles of the terms by sources table: a slice of
terms and two bands of sources meet in one task, which adds up their columns' distances.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waypost.workspace import fits_broadcast, release, settle

#: Documents of a language that must hold a term for it to be kept.
MIN_DOCS = 30

#: Added to each count, and what all proportions of a group come to, about.
SMOOTHING = 5
SCALE = 1_000_000_000

#: Ranks that are listed of a group's terms.
TOP_TERMS = 50

#: Sources in a band, and kept terms in a slice of a tile, about.
BAND = 256
SLICE_TERMS = 8192

#: Different entries, and bytes of text, a map task counts before it hands them on.
HELD_ENTRIES = 400_000
HELD_BYTES = 128 << 20

# Fixed value: ASCII letters and everything beyond ASCII, in UTF-8.
_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")

_TALLY = "lang string, source string, term string, n long, docs long"


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order, with A-Z in lower case and nothing else changed."""
    return _TERM.findall(text.lower())


def _tallying(held_entries: int, held_bytes: int):
    names = ["lang", "source", "term", "n", "docs"]
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]

    def rows(counts, docs):
        out = [
            (lang, source, term, n, docs[lang, source][term])
            for (lang, source), found in counts.items()
            for term, n in found.items()
        ]
        # A group without a term still is a group.
        out += [(lang, source, None, 0, 0) for lang, source in counts]
        columns = list(zip(*out))
        columns[2] = [None if t is None else t.decode() for t in columns[2]]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, docs, size = defaultdict(Counter), defaultdict(Counter), 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = terms(text)
                counts[lang, source].update(found)
                docs[lang, source].update(set(found))
                size += len(text)
                if size > held_bytes:
                    yield rows(counts, docs)
                    counts, docs, size = defaultdict(Counter), defaultdict(Counter), 0
            if sum(map(len, counts.values())) > held_entries:
                yield rows(counts, docs)
                counts, docs, size = defaultdict(Counter), defaultdict(Counter), 0
        if counts:
            yield rows(counts, docs)

    return tally


def tally_terms(
    docs: DataFrame,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    held_entries: int = HELD_ENTRIES,
    held_bytes: int = HELD_BYTES,
) -> DataFrame:
    """Occurrences ``n`` and documents ``docs`` of each term per (lang, source).

    A group also has one row with a null term. Null texts, languages and sources count
    as empty.
    """
    source = docs.select(
        F.coalesce(F.col(lang_col), F.lit("")).alias("lang"),
        F.coalesce(F.col(source_col), F.lit("")).alias("source"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    raw = source.mapInArrow(_tallying(held_entries, held_bytes), _TALLY)
    return raw.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _proportion(count: str, total: str, n_terms: str) -> Column:
    """1 + floor(SCALE * (count + SMOOTHING) / (total + SMOOTHING * n_terms)), exact for all longs."""
    return F.expr(
        f"1 + (cast({count} + {SMOOTHING} AS decimal(20,0)) * cast({SCALE} AS decimal(10,0)))"
        f" div cast({total} + {SMOOTHING} * {n_terms} AS decimal(20,0))"
    )


def _meet(rows: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    """An inner join with a table of a row per key, broadcast if a look at it shows that it is small."""
    return rows.join(F.broadcast(side) if fits_broadcast(side) else side, keys)


def _kept(tallies: DataFrame, min_docs: int) -> DataFrame:
    """Rows of kept terms with ``lang_n``, and ``first`` on one row of each (lang, term)."""
    same = Window.partitionBy("lang", "term")  # a row per source
    return (
        tallies.filter("term IS NOT NULL")
        .withColumns(
            {
                "lang_docs": F.sum("docs").over(same),
                "lang_n": F.sum("n").over(same),
                "first": F.row_number().over(same.orderBy("source")) == 1,
            }
        )
        .filter(F.col("lang_docs") >= min_docs)
        .select("lang", "source", "term", "n", "lang_n", "first")
    )


def _totals(tallies: DataFrame, kept: DataFrame) -> DataFrame:
    """Per group its sum, its language's sum and number of terms, and the group's place in it."""
    counted = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count_if("first").alias("firsts")
    )
    # A language has a row per source here, and the answer a row per pair of them.
    lang = Window.partitionBy("lang")
    return (
        tallies.filter("term IS NULL")
        .select("lang", "source")
        .join(counted, ["lang", "source"], "left")
        .select(
            "lang",
            "source",
            F.coalesce("total", F.lit(0)).alias("total"),
            F.coalesce(F.sum("total").over(lang), F.lit(0)).alias("lang_total"),
            F.coalesce(F.sum("firsts").over(lang), F.lit(0)).alias("n_terms"),
            (F.row_number().over(lang.orderBy("source")) - 1).alias("place"),
        )
    )


def _top_terms(kept: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The ``top`` terms that each group has oftener than its language, by cells of equal counts."""
    cell = ["lang", "source", "n", "lang_n"]
    cells = _meet(kept.groupBy(*cell).agg(F.count("*").alias("many")), totals, ["lang", "source"])
    gap = _proportion("n", "total", "n_terms") - _proportion("lang_n", "lang_total", "n_terms")
    cells = cells.withColumn("value", gap).filter("value > 0").select(*cell, "value", "many")
    # Cells of equal value share their ranks; of ``top`` values each holds a term at least.
    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    values = (
        cells.groupBy("lang", "source", "value")
        .agg(F.sum("many").alias("many"))
        .withColumn("nth", F.row_number().over(group))
        .filter(F.col("nth") <= top)
        .withColumn("before", F.sum("many").over(group) - F.col("many"))
        .filter(F.col("before") < top)
        .select("lang", "source", "value", "before")
    )
    ranked = cells.select(*cell, "value").join(values, ["lang", "source", "value"])
    # No more terms of a cell are listed than there are ranks; the limit goes before the shuffle.
    by_bytes = Window.partitionBy(*cell).orderBy("term")
    names = kept.select(*cell, "term").withColumn("nth", F.row_number().over(by_bytes)).filter(F.col("nth") <= top)
    in_value = Window.partitionBy("lang", "source", "value").orderBy("term")
    return (
        names.join(ranked, cell)
        .withColumn("rank", (F.col("before") + F.row_number().over(in_value)).cast("int"))
        .filter(F.col("rank") <= top)
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    )


def _tile(rows: pa.Table, heads: pa.Table) -> pa.Table:
    """Distances between the columns of a slice of terms, for the two bands of ``heads``."""
    heads = heads.sort_by("place")
    place, band = heads["place"].to_numpy(), heads["band"].to_numpy()
    absent, source = heads["absent"].to_numpy(), heads["source"]
    n_terms, lang = heads["n_terms"], heads["lang"]
    low, high = heads["low"][0].as_py(), heads["high"][0].as_py()
    term = rows["term"].combine_chunks().dictionary_encode()
    if isinstance(term, pa.ChunkedArray):
        term = term.combine_chunks()
    table = np.repeat(absent[None, :], len(term.dictionary), axis=0)
    table[term.indices.to_numpy(), np.searchsorted(place, rows["place"].to_numpy())] = rows["p"].to_numpy()
    one, other, value = [], [], []
    for at in np.flatnonzero(band == low):
        to = np.flatnonzero((band == high) & (place > place[at]))
        if len(to):
            one.append(np.full(len(to), at))
            other.append(to)
            value.append(np.abs(table[:, to] - table[:, [at]]).sum(axis=0))
    one, other, value = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (one, other, value))
    return pa.table(
        {
            "lang": lang.take(pa.array(one)),
            "one": source.take(pa.array(one)),
            "other": source.take(pa.array(other)),
            "value": pa.array(value, pa.int64()),
            "seen": pa.array(np.full(len(one), len(term.dictionary)), pa.int64()),
            "n_terms": n_terms.take(pa.array(one)),
            "apart": pa.array(np.abs(absent[one] - absent[other]), pa.int64()),
        }
    )


def _pairs(kept: DataFrame, totals: DataFrame, band: int, slice_terms: int) -> DataFrame:
    """The distance of each two sources of a language, both ways."""
    heads = totals.withColumns(
        {
            "band": F.floor(F.col("place") / band).cast("int"),
            "slices": F.floor(F.col("n_terms") / slice_terms).cast("int") + 1,
            "absent": F.when(F.col("n_terms") > 0, _proportion("0", "total", "n_terms")).otherwise(F.lit(0)),
        }
    )
    bands = Window.partitionBy("lang")
    heads = settle(heads.withColumn("bands", F.max("band").over(bands) + 1), "heads")

    def dealt(rows: DataFrame) -> DataFrame:
        """Each row to the tiles of its band, which are a row and a column of bands."""
        other = F.explode(F.sequence(F.lit(0), F.col("bands") - 1))
        return rows.withColumn("_other", other).withColumns(
            {"low": F.least("band", "_other"), "high": F.greatest("band", "_other")}
        )

    p = _proportion("n", "total", "n_terms")
    rows = _meet(kept.select("lang", "source", "term", "n"), heads, ["lang", "source"])
    rows = dealt(rows.withColumn("p", p)).withColumn("slice", F.pmod(F.xxhash64("term"), "slices").cast("int"))
    rows = rows.select("lang", "low", "high", "slice", "term", F.col("place").alias("place"), "p")
    tops = dealt(heads).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    tops = tops.select("lang", "low", "high", "slice", "source", "place", "band", "absent", "n_terms")
    tile = ["lang", "low", "high", "slice"]
    sums = rows.groupBy(*tile).cogroup(tops.groupBy(*tile)).applyInArrow(
        _tile, "lang string, one string, other string, value long, seen long, n_terms long, apart long"
    )
    pairs = sums.groupBy("lang", "one", "other").agg(
        # Terms that no source of the tile has are apart by as much each.
        (F.sum("value") + (F.max("n_terms") - F.sum("seen")) * F.max("apart")).alias("value")
    )
    there = pairs.select("lang", F.col("one").alias("source"), F.col("other").alias("item"), "value")
    back = pairs.select("lang", F.col("other").alias("source"), F.col("one").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return there.union(back).select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def source_divergence(
    docs: DataFrame,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP_TERMS,
    band: int = BAND,
    slice_terms: int = SLICE_TERMS,
) -> DataFrame:
    """Per (lang, source) its distance to each other source of the language, and its own terms.

    Columns: ``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``. In the part
    ``pair`` the item is another source and the value the sum of the differences of their
    proportions over the language's kept terms; in the part ``term`` the item is a kept
    term that the group has oftener than its language, with the difference of the two,
    for the first ``top`` ranks. Ranks go by falling value, then by the item's bytes.

    A language keeps the terms that ``min_docs`` of its documents hold. Null texts,
    languages and sources count as empty; a group whose texts are empty is a group, and
    without kept terms all its distances are 0 and it has no terms. A term may be as long
    as a text. Repeated rows count as often as they come, other columns are not read,
    and no rows give no rows. A language's list of sources meets in one task, as does a
    tile of ``slice_terms`` terms and two bands of ``band`` sources.
    """
    tallies = settle(
        tally_terms(docs, text_col=text_col, lang_col=lang_col, source_col=source_col), "term-tallies"
    )
    kept = settle(_kept(tallies, min_docs), "kept-terms")
    totals = settle(_totals(tallies, kept), "group-totals")
    release(tallies)
    return _pairs(kept, totals, band, slice_terms).unionByName(_top_terms(kept, totals, top))
