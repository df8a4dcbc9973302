"""Vectorised word splitting and hashing over Arrow text buffers.

Separators of both word rules are ASCII, and in UTF-8 no ASCII byte occurs
inside a longer character, so classifying bytes is exact.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _lower() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[0x41:0x5B] += 32
    return t


LOWER = _lower()

#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z.
ALNUM = np.zeros(256, bool)
ALNUM[0x80:] = ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x41:0x5B] = True

#: `[^\x20\x09-\x0D]+`
NONSPACE = np.ones(256, bool)
NONSPACE[0x20] = NONSPACE[0x09:0x0E] = False


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))[LOWER]
_POW = np.ones(1, np.uint64)
_INV = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        size = max(n, 1 << 16)
        _POW = np.full(size, _BASE, np.uint64)
        _INV = np.full(size, _INVERSE, np.uint64)
        _POW[0] = _INV[0] = 1
        np.multiply.accumulate(_POW, out=_POW)
        np.multiply.accumulate(_INV, out=_INV)
    return _POW, _INV


class Words:
    """Words of a run of texts: byte starts and ends, 64-bit hashes of the
    lower-cased words, and ``bounds``: text d has words bounds[d]:bounds[d+1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, rule: np.ndarray):
        n = len(data)
        inside = np.zeros(n + 1, bool)
        inside[:n] = rule[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        starts = inside.copy()
        starts[1:] &= ~inside[:-1] | edge[1:]
        ends = inside[:n] & (~inside[1:] | edge[1:])
        self.data = data
        self.starts = np.flatnonzero(starts)
        self.ends = np.flatnonzero(ends) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        if len(self.starts):
            power, inverse = _powers(n)
            part = np.where(rule, _CODE, np.uint64(0))[data]
            part *= power[:n]
            sums = np.add.reduceat(part, self.starts)
            self.hashes = mix(sums * inverse[self.starts])
        else:
            self.hashes = np.empty(0, np.uint64)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def doc_of(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def prefixes(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words' first k bytes, and which words are longer than that."""
        longer = self.ends - self.starts > k
        h = np.full(len(self.starts), k, np.uint64)
        last = len(self.data) - 1
        for j in range(k):
            h = h * np.uint64(0xD6E8FEB86659FD93) + _CODE[self.data[np.minimum(self.starts + j, last)]]
        return mix(h), longer

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rolling k-word hashes by start word, and which starts stay inside one text."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, bool)
        return gram_hashes(self.hashes, k), within(self.bounds, k, n)


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += h[j:j + n]
    return mix(out)


def within(bounds: np.ndarray, k: int, n: int) -> np.ndarray:
    """Whether the k words from each start lie in one text."""
    counts = np.diff(bounds)
    last = np.repeat(bounds[1:], counts)[:n]
    return np.arange(n) + k <= last


def hash_words(text: str) -> np.ndarray:
    """Hashes of one text's words by the letters-and-digits rule."""
    data = np.frombuffer(text.encode(), np.uint8)
    return Words(data, np.array([0, len(data)]), ALNUM).hashes
