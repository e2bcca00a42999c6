"""Spelling variants of a corpus's words, by a dictionary of pairs of trie nodes.

The words, sorted, make a trie, and the reversed words another; both tries' nodes are
numbered. A word is then two lists of integers: the nodes of its prefixes and those of
its suffixes. Leaving out the character at a place leaves a pair (prefix node, suffix
node), as does any place between two characters without leaving one out. Two words
differ by one replaced character where they leave the same pair, and by one inserted or
deleted character where the one's pair without a character is the other's with all; so
equal pairs of integers give exact neighbours, and no strings are compared. At most one
word per character of the alphabet meets at a pair.

Numbers are given in one sorted pass over range partitions. A word introduces the nodes
of its prefixes that are longer than what it shares with the word before, and these are
numbered in order; only the first word of a partition may share nodes with earlier ones,
so a look at the first and last word of each partition is all that passes between them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waypost.workspace import release, settle

#: Fewest characters and occurrences of a word.
MIN_LENGTH = 7
MIN_COUNT = 2

#: How many times as frequent a word's form is, at least.
RATIO = 10

#: Different words, and bytes of text, a map task counts before it hands them on.
HELD_WORDS = 400_000
HELD_BYTES = 128 << 20

#: One in so many runs of a document, by its hash, loses a character.
MISSPELT = 31

#: Bits of a node's number within its partition.
_LOCAL = 40

#: Integers in a record batch that a task hands on, about.
_HANDED = 500_000

_UPPER = str.maketrans({c: c + 32 for c in range(ord("A"), ord("Z") + 1)})


def misspelt(doc_id, run: str, one_in: int = MISSPELT) -> str:
    """The run, without one character if its hash in the document says so."""
    hashed = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if hashed % one_in:
        return run
    at = hashed % len(run)
    return run[:at] + run[at + 1 :]


def _counting(min_length: int, one_in: int | None, held_words: int, held_bytes: int):
    # Fixed value: the characters of a run. Shorter runs are no words, whatever they lose.
    run = re.compile(rf"[A-Za-zÀ-ÿ]{{{min_length},}}")

    def out(counts):
        return pa.record_batch(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, size = Counter(), 0
        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = run.findall((text or "").translate(_UPPER)) if text else []
                if one_in is None:
                    counts.update(found)
                else:
                    for word, n in Counter(found).items():
                        word = misspelt(doc_id, word, one_in)
                        if len(word) >= min_length:
                            counts[word] += n
                size += len(text or "")
                if len(counts) > held_words or size > held_bytes:
                    yield out(counts)
                    counts, size = Counter(), 0
        if counts:
            yield out(counts)

    return count


def count_words(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    one_in: int | None = None,
    held_words: int = HELD_WORDS,
    held_bytes: int = HELD_BYTES,
) -> DataFrame:
    """``word`` and ``n`` of the words of at least ``min_length`` characters and ``min_count`` occurrences.

    Words are maximal runs of Latin letters with A-Z in lower case. ``one_in`` misspells
    one in so many of a document's runs first (see ``misspelt``), by the id, which is
    empty if null; None takes the texts as they are. A null text has no words.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = source.mapInArrow(_counting(min_length, one_in, held_words, held_bytes), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _shared(one: str, other: str) -> int:
    """Characters at the start that two strings share."""
    n = min(len(one), len(other))
    if one[:n] == other[:n]:
        return n
    low = 0
    while n - low > 1:  # one[:low] is shared, one[:n] is not
        half = (low + n) // 2
        if one[low:half] == other[low:half]:
            low = half
        else:
            n = half
    return low


def _numbering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the prefixes of each word of a sorted partition, in the order of their depth."""
    part = TaskContext.get().partitionId()
    following, before, nodes = part << _LOCAL, None, np.empty(0, np.int64)
    words, lists, size = [], [], 0

    def out():
        ends = np.cumsum([0, *map(len, lists)])
        nested = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(lists), pa.int64()))
        parts = pa.array(np.full(len(words), part, np.int64))
        return pa.record_batch([pa.array(words, pa.string()), parts, nested], ["word", "part", "nodes"])

    for batch in batches:
        for word in batch.column(0).to_pylist():
            kept = 0 if before is None else _shared(before, word) + 1
            fresh = len(word) + 1 - kept
            nodes = np.concatenate((nodes[:kept], np.arange(following, following + fresh)))
            following += fresh
            before = word
            words.append(word)
            lists.append(nodes)
            size += len(nodes)
            if size > _HANDED:
                yield out()
                words, lists, size = [], [], 0
    if words:
        yield out()


def _carried(numbered: DataFrame) -> list[tuple[int, list[int]]]:
    """Per partition, the nodes of earlier ones that its first word's prefixes have.

    Two words of each partition come to the driver, and what they share.
    """
    ends = (
        numbered.groupBy("part")
        .agg(F.min("word").alias("first"), F.max("word").alias("last"), F.max_by("nodes", "word").alias("nodes"))
        .orderBy("part")
        .collect()
    )
    out, before, nodes = [], None, []
    for end in ends:
        shared = [] if before is None else nodes[: _shared(before, end["first"]) + 1]
        out.append((end["part"], shared))
        own, start = list(end["nodes"]), end["part"] << _LOCAL
        # The last word's nodes that are the first word's, and through it those before.
        nodes = [shared[n - start] if n - start < len(shared) else n for n in own]
        before = end["last"]
    return out


def number_nodes(words: DataFrame) -> DataFrame:
    """``word``, ``part`` and ``nodes``: the trie node of each of its prefixes, the empty one first.

    Equal prefixes of any two of the distinct words have equal numbers, others do not.
    """
    sorted_ = words.select("word").repartitionByRange("word").sortWithinPartitions("word")
    numbered = settle(sorted_.mapInArrow(_numbering, "word string, part long, nodes array<long>"), "trie-nodes")
    # A row per partition.
    carried = words.sparkSession.createDataFrame(_carried(numbered), "part long, shared array<long>")
    local = lambda n: n - F.shiftleft("part", _LOCAL)
    fixed = F.transform("nodes", lambda n: F.when(local(n) < F.size("shared"), F.get("shared", local(n).cast("int"))).otherwise(n))
    return numbered.join(F.broadcast(carried), "part").select("word", "part", fixed.alias("nodes"))


# How a row reached its pair: with all characters, or without one; FIRST if the one left
# out is the first of a run of equal ones, of which any gives the same word.
_WHOLE, _FIRST, _OTHER = 0, 1, 2


def _pairing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per pair of a word: prefix node, suffix node, how, the word's number and count."""
    names = ["prefix", "suffix", "how", "word", "n"]
    kinds = [np.int64, np.int64, np.int8, np.int64, np.int64]
    parts, size = [[] for _ in names], 0

    def out():
        return pa.record_batch([pa.array(np.concatenate(p).astype(k)) for p, k in zip(parts, kinds)], names)

    for batch in batches:
        key, n = (batch.column(k).to_pylist() for k in (0, 1))
        word, prefixes, suffixes = (batch.column(k) for k in (2, 3, 4))
        for k in range(batch.num_rows):
            prefix = prefixes[k].values.to_numpy()
            suffix = suffixes[k].values.to_numpy()[::-1]
            codes = np.frombuffer(word[k].as_py().encode("utf-32-le"), np.uint32)
            first = np.concatenate(([True], codes[1:] != codes[:-1]))[: len(codes)]
            how = np.concatenate((np.full(len(prefix), _WHOLE), np.where(first, _FIRST, _OTHER)))
            rows = (np.concatenate((prefix, prefix[:-1])), np.concatenate((suffix, suffix[1:])), how)
            for p, values in zip(parts, (*rows, np.full(len(how), key[k]), np.full(len(how), n[k]))):
                p.append(values)
            size += len(how)
            if size > _HANDED:
                yield out()
                parts, size = [[] for _ in names], 0
    if size:
        yield out()


def _neighbours(pairs: DataFrame) -> DataFrame:
    """Per ``word`` (number) how many neighbours it has, ``n_near``, and the ``best`` of them (-n, word)."""
    row = F.struct((-F.col("n")).alias("minus_n"), "word", "how")
    met = (
        pairs.groupBy("prefix", "suffix")
        .agg(F.array_sort(F.collect_list(row)).alias("rows"))  # no more rows than the alphabet and one
        .filter((F.size("rows") > 1) & F.exists("rows", lambda r: r["how"] != _WHOLE))
    )
    # Best first, so the best other one of a row is the first or the second.
    whole = F.filter("rows", lambda r: r["how"] == _WHOLE)
    less = F.filter("rows", lambda r: r["how"] != _WHOLE)
    once = F.filter("rows", lambda r: r["how"] == _FIRST)
    met = met.select(whole.alias("whole"), less.alias("less"), once.alias("once"))
    best = lambda r: F.struct(r["minus_n"].alias("minus_n"), r["word"].alias("word"))

    def found(word: Column, n_near: Column, of: Column) -> Column:
        return F.struct(word.alias("word"), n_near.cast("long").alias("n_near"), best(of).alias("best"))

    replaced = F.transform(
        "less",
        lambda r: found(
            r["word"], F.size("less") - 1,
            F.when(F.get("less", F.lit(0))["word"] == r["word"], F.get("less", F.lit(1))).otherwise(F.get("less", F.lit(0))),
        ),
    )
    shorter = F.transform("once", lambda r: found(r["word"], F.size("whole"), F.get("whole", F.lit(0))))
    longer = F.transform("whole", lambda r: found(r["word"], F.size("once"), F.get("once", F.lit(0))))
    rows = met.select(F.explode(F.concat(replaced, shorter, longer)).alias("x")).select("x.*").filter("n_near > 0")
    return rows.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and its ``root``, following ``form`` to the end; each round doubles the steps.

    A form is ``RATIO`` times as frequent, so a chain has no more steps than a count has digits.
    """
    roots = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = roots.join(onward, "root", "left")
        further = settle(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        release(roots)
        if further.filter("moved").isEmpty():
            return further.drop("moved")
        roots = further.drop("moved")


def spelling_variants(words: DataFrame, *, ratio: int = RATIO) -> DataFrame:
    """``word``, ``n``, ``form``, ``root``, ``n_near`` and ``form_n`` of each of ``words`` (``word``, ``n``).

    Two words are near if one inserted, deleted or replaced character tells them apart.
    A word's form is the most frequent word near it, of equally frequent ones the first
    in the order of characters, if it is at least ``ratio`` (more than 1) times as
    frequent; else null. Its root is the last of the forms that follow from it, itself if
    it has none. ``n_near`` counts the words near it, and ``form_n`` is its form's count.
    Rows without a word or a positive count are left out, counts of a repeated word are added up, words may be
    of any length, an empty word is near each of one character, other columns are not
    read, and no rows give no rows.
    """
    if ratio <= 1:
        raise ValueError("a form is more frequent than its word")
    words = words.select("word", "n").filter("word IS NOT NULL AND n > 0")
    words = settle(words.groupBy("word").agg(F.sum("n").cast("long").alias("n")), "words")
    forward = number_nodes(words)
    backward = number_nodes(words.select(F.reverse("word").alias("word")))
    backward = backward.select(F.reverse("word").alias("word"), F.col("nodes").alias("suffixes"))
    # The last prefix of a word is the word, so its node's number is the word's.
    both = forward.join(backward, "word").join(words, "word")
    key = F.element_at("nodes", -1)
    both = settle(both.select(key.alias("key"), "n", "word", "nodes", "suffixes"), "word-nodes")
    pairs = both.mapInArrow(_pairing, "prefix long, suffix long, how tinyint, word long, n long")
    near = settle(_neighbours(pairs), "near-words")
    names = settle(both.select("key", "n", "word"), "word-numbers")
    release(both)
    chosen = (
        names.join(near.select(F.col("word").alias("key"), "n_near", "best"), "key", "left")
        .select(
            "key",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(-F.col("best.minus_n") >= ratio * F.col("n"), F.col("best")).alias("best"),
        )
    )
    chosen = settle(chosen, "forms")
    with_form = chosen.filter("best IS NOT NULL")
    roots = _roots(with_form.select(F.col("key").alias("word"), F.col("best.word").alias("form")))
    named = names.select("key", "word")
    linked = with_form.select("key", "word", "n", "n_near", F.col("best.word").alias("form_key"), (-F.col("best.minus_n")).alias("form_n"))
    linked = linked.join(roots.select(F.col("word").alias("key"), F.col("root").alias("root_key")), "key")
    linked = linked.join(named.select(F.col("key").alias("form_key"), F.col("word").alias("form")), "form_key")
    linked = linked.join(named.select(F.col("key").alias("root_key"), F.col("word").alias("root")), "root_key")
    none = F.lit(None)
    alone = chosen.filter("best IS NULL").select(
        "word", none.cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", none.cast("long").alias("form_n")
    )
    return linked.select(*alone.columns).union(alone)
