"""Word shingles as 64-bit fingerprints, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def words(text: bytes) -> list[bytes]:
    """Runs of anything but ASCII white space, with A-Z in lower case."""
    return text.lower().split()


def word_prints(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def sequence_prints(prints: np.ndarray, n: int) -> np.ndarray:
    """A print for each run of ``n`` words, in order; fewer words are one run."""
    n_words = len(prints)
    if not n_words:
        return prints
    n = min(n, n_words)
    out = np.full(n_words - n + 1, mix(np.full(1, n, np.uint64))[0])
    for k in range(n):
        out = mix(out + _STEP) ^ prints[k : n_words - n + 1 + k]
    return mix(out)


def shingle_set(text: bytes, n: int) -> np.ndarray:
    """The sorted distinct shingles of a text's words; none if it has no words."""
    return np.unique(sequence_prints(word_prints(words(text)), n))
