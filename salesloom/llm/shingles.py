"""Word shingles of a text as 64-bit hashes, and MinHash signatures of the sets."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
WORDS_KEPT = 200_000  # hashes of words remembered by a worker; only speed depends on it

# A-Z only; other letters stay as they are
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)
_SHIFT = np.uint64(31)
# odd factors, one for each place of a word in its shingle
_PLACES = np.random.default_rng(5).integers(0, 2**63, 16, np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words; ``bytes.split`` cuts at exactly \\x20 and \\x09-\\x0D."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> _SHIFT)) * _MIX
    values = (values ^ (values >> _SHIFT)) * _MIX2
    return values ^ (values >> _SHIFT)


def shingle_set(text: str | None, hashes: WordHashes, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct shingles of a text.

    Fewer words than ``width`` make one shingle of the whole sequence; no word
    makes an empty set.
    """
    words = words_of(text)
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    take = min(n, width)
    total = np.full(n - take + 1, np.uint64(take))
    for k in range(take):
        total += h[k:n - take + 1 + k] * _PLACES[k]
    total = mixed(total)
    total.sort()
    return total[np.concatenate(([True], total[1:] != total[:-1]))]


class MinHash:
    """``size`` minima of a set under as many hash functions, as signed 64-bit values.

    The coordinate is part of each function, so that equal values always stand
    for the same coordinate.
    """

    CHUNK = 4096  # shingles hashed at a time, so memory does not follow the text

    def __init__(self, size: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.flip = rng.integers(0, 2**64, size, np.uint64, endpoint=False)
        self.factor = rng.integers(0, 2**64, size, np.uint64, endpoint=False) | np.uint64(1)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        best = np.full(len(self.flip), np.uint64(2**64 - 1))
        for start in range(0, len(shingles), self.CHUNK):
            part = shingles[start:start + self.CHUNK, None] ^ self.flip
            part *= self.factor
            part ^= part >> np.uint64(29)
            part *= self.factor
            np.minimum(best, part.min(axis=0), out=best)
        return mixed(best + self.flip).view(np.int64)
