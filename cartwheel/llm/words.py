"""Vectorised words, word hashes and shingle hashes of the texts of an Arrow column.

A word is a maximal run of bytes other than space, tab and the line breaks
0x0A-0x0D; texts never share a word.  Hashes are sums of byte values times
powers of an odd number modulo 2^64, taken from running sums, and mixed.
``seed`` gives independent hash functions; two of them make a 128-bit key.
"""

from __future__ import annotations

import numpy as np

from .worker import cached

#: White space between words, as bytes.
SPACES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (in a new array)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _odd(seed: int, salt: int) -> int:
    return int(mix(np.array([seed * 1_000_003 + salt], np.uint64))[0]) | 1


def _powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the seed's odd base and of its inverse modulo 2^64, at least n of them."""
    def build(size):
        base = _odd(seed, 7)
        up = np.full(size, base, np.uint64)
        down = np.full(size, pow(base, -1, 2 ** 64), np.uint64)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)
    have = cached(f"powers:{seed}", lambda: build((1 << 20) + 2), slot="powers", most=3)
    return have if len(have[0]) >= n else build(n)  # those for a single very long text are not kept


def _values(seed: int) -> np.ndarray:
    return cached(f"bytes:{seed}", lambda: mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_odd(seed, 11))))


class SpanHasher:
    """Hashes of arbitrary byte spans of one buffer."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        self.up, self.down = _powers(seed, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_values(seed)[data] * self.up[:len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text index) of the runs of True that do not cross a text's bounds."""
    n = len(is_word)
    if not n:
        return (np.empty(0, np.int64),) * 3
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, is_word[:-1]
    start = np.flatnonzero(is_word & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, is_word[1:]
    end = np.flatnonzero(is_word & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def word_mask(data: np.ndarray) -> np.ndarray:
    table = np.ones(256, bool)
    table[list(SPACES)] = False
    return table[data]


class Words:
    """Words of a slice of texts: spans, text index of each word, first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = data
        self.start, self.end, self.text = spans(word_mask(data), offsets)
        self.count = np.bincount(self.text, minlength=len(offsets) - 1)
        self.first = np.concatenate([[0], np.cumsum(self.count)])

    def hashes(self, seed: int = 0) -> np.ndarray:
        return SpanHasher(self.data, seed)(self.start, self.end)

    def shingles(self, hashes: np.ndarray, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of ``size`` words within one text."""
        if len(hashes) < size:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        at = np.flatnonzero(self.text[:len(hashes) - size + 1] == self.text[size - 1:])
        return at, self.runs(hashes, at, size, seed)

    def runs(self, hashes: np.ndarray, at: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
        """Hash of the ``size`` words from each position on."""
        base, out = np.uint64(_odd(seed, 23)), np.zeros(len(at), np.uint64)
        for j in range(size):
            out = out * base + hashes[at + j]
        return mix(out)
