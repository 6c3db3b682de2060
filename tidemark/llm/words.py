"""Word hashes and shingle sets of one text, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

_STEP = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the runs without ASCII white space, A-Z in lower case."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(text: str | None, width: int) -> np.ndarray:
    """The sorted set of ``width``-word shingles as 64-bit hashes; a shorter text is one shingle, a wordless one none."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    run = np.full(n, width, np.uint64)
    for k in range(width):
        run = mixed(run * _STEP + words[k:k + n])
    return np.unique(run)
