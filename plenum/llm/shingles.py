"""Word shingles of texts as 64-bit hashes, many texts at a time."""

from __future__ import annotations

import numpy as np
import xxhash

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words (ASCII white space parts them; A-Z count as a-z) of a UTF-8 text."""
    words = text.lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_set(text: bytes, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of `width` words; of a shorter text, of all its words as one."""
    h = word_hashes(text)
    n = len(h)
    if n == 0:
        return h
    size = min(n, width)
    out = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        out = out * _MULTIPLIER + h[k : n - size + 1 + k]
    return np.unique(mixed(out + np.uint64(size if size < width else 0)))
