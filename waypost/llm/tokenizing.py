"""Word-wise encoding with a tokenizer file, for use inside tasks.

Both kinds of file here split a text before every single space between words, whatever
stands around it, so the encoding of a text is that of its space-separated words one
after another. Arrow splits a slice of texts and numbers its distinct words; only those
that the worker has not met lately are encoded, many in one call. Texts where a space
lies inside a longer run of white space, which a byte-level file keeps as one piece, are
encoded whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters of words after which a worker's table is put aside and a new one begun.
TABLE_CHARS = 4_000_000

#: Bytes of texts that are looked up in one go.
SLICE_BYTES = 8_000_000

#: Words that are encoded in one call, as the library holds some 100 bytes for each of their pieces.
CALL_WORDS = 20_000

_WHITE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

#: A space that white space precedes and white space or the end follows.
INNER_SPACE = rf"{_WHITE} (?:{_WHITE}|\z)"


def open_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def slices(texts: pa.StringArray) -> Iterator[pa.StringArray]:
    """Runs of texts of about ``SLICE_BYTES``; a longer text is a run of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + SLICE_BYTES)))
        yield texts.slice(start, stop - start)
        start = stop


class WordTable:
    """The ids of each word met lately, with ``prefix`` before it, as 32-bit integers."""

    def __init__(self, path: str, prefix: str, mark: str):
        """``mark`` stands between words that are encoded in one call.

        It is a piece by itself there and no printable word can contain it.
        """
        self.tokenizer = open_tokenizer(path)
        self.prefix, self.mark = prefix, mark
        self.mark_ids = self.tokenizer.encode(mark.strip(" ") or mark, add_special_tokens=False).ids
        assert len(self.mark_ids) == 1
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the table before; what is still used moves over
        self.chars = 0

    def encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def encode_words(self, words: list[str], prefix: str) -> list[bytes]:
        """Ids of each word, ``CALL_WORDS`` at a time."""
        found: list[bytes] = []
        for start in range(0, len(words), CALL_WORDS):
            found += self._encode_words(words[start : start + CALL_WORDS], prefix)
        return found

    def _encode_words(self, words: list[str], prefix: str) -> list[bytes]:
        """Those that are not plain text go one by one."""
        plain = [w for w in words if w and w.isprintable()]
        joined = self.mark.join([prefix + w for w in plain])
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(ids == self.mark_ids[0])
        starts = np.append(0, 4 * (cuts + 1)).tolist()
        ends = np.append(4 * cuts, 4 * len(ids)).tolist()
        data = ids.tobytes()
        found = dict(zip(plain, [data[s:e] for s, e in zip(starts, ends)])) if plain else {}
        rest = [w for w in words if w not in found]
        found.update(zip(rest, self.encode([prefix + w for w in rest])))
        return [found[w] for w in words]

    def look_up(self, words: list[str]) -> list[bytes]:
        if self.chars > TABLE_CHARS:
            self.older, self.known, self.chars = self.known, {}, 0
        known, older = self.known, self.older
        new = [w for w in words if w not in known]
        if new:
            moved = {w: older[w] for w in new if w in older}
            missing = [w for w in new if w not in moved] if moved else new
            known.update(moved)
            known.update(zip(missing, self.encode_words(missing, self.prefix)))
            self.chars += sum(map(len, new))
        return [known[w] for w in words]

    def words(self, texts: pa.StringArray) -> tuple[np.ndarray, pa.DictionaryArray]:
        """Where each text's words start, with the end, and all words, numbered."""
        split = pc.split_pattern(texts, " ")
        offsets = split.offsets.to_numpy()
        words = split.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).dictionary_encode()
        return offsets - offsets[0], words


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """The worker's own; a later task of the worker finds the words of the one before."""
    return Counter(path)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Counter:
    """Token counts of texts under a byte-level file."""

    def __init__(self, path: str):
        self.table = WordTable(path, prefix=" ", mark="\n")

    def __call__(self, texts: pa.StringArray) -> np.ndarray:
        return np.concatenate([np.empty(0, np.int64), *map(self._count, slices(texts))])

    def _count(self, texts: pa.StringArray) -> np.ndarray:
        whole = pc.match_substring_regex(texts, INNER_SPACE)
        offsets, words = self.table.words(pc.if_else(whole, "", texts))
        each = np.array([len(x) // 4 for x in self.table.look_up(words.dictionary.to_pylist())], np.int64)
        index = words.indices.to_numpy()
        sums = np.append(0, np.cumsum(each[index]))
        # No space stands before a text's first word.
        starts = offsets[:-1]
        firsts = words.dictionary.take(pa.array(index[starts])).to_pylist()
        first = {w: len(x) // 4 for w, x in zip(set(firsts), self.table.encode_words(list(set(firsts)), ""))}
        counts = sums[offsets[1:]] - sums[starts + 1] + np.array([first[w] for w in firsts], np.int64)
        for k in np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist():
            counts[k] = len(self.table.encode([texts[k].as_py()])[0]) // 4
        return counts


class Encoder:
    """Ids of texts, as little-endian unsigned 32-bit integers, under a file that drops white space."""

    def __init__(self, path: str):
        self.table = WordTable(path, prefix="", mark=" \x00 ")

    def __call__(self, texts: pa.StringArray) -> Iterator[bytes]:
        for held in slices(texts):
            offsets, words = self.table.words(pc.replace_substring(held, "\n", " "))
            ids = pa.array(self.table.look_up(words.dictionary.to_pylist()), pa.large_binary())
            laid = ids.take(words.indices)  # one after another in memory
            _, at, data = laid.buffers()
            ends = np.frombuffer(at, np.int64)[laid.offset : laid.offset + len(laid) + 1][offsets].tolist()
            view = memoryview(data) if data is not None else memoryview(b"")
            for start, end in zip(ends[:-1], ends[1:]):
                yield bytes(view[start:end])
