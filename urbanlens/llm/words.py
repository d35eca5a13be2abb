"""Vectorised word views of text columns: words, their 64-bit hashes, k-grams
and winnowed fingerprints, all from the UTF-8 bytes of a batch."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from urbanlens.llm.common import mix64

# Words are runs of [^\x00-\x2F\x3A-\x60\x7B-\x7F] after folding A-Z: in UTF-8 these
# are exactly the bytes 0-9, a-z and all bytes of non-ASCII characters.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = True
_IS_WORD[0x80:] = True
_BYTE_HASH = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@lru_cache(1)
def _usual_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(_BASE, n), _powers(pow(_BASE, -1, 2**64), n)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    usual = 1 << 21
    if n <= usual:
        up, down = _usual_powers(usual)
        return up[:n], down[:n]
    return _powers(_BASE, n), _powers(pow(_BASE, -1, 2**64), n)


class Words:
    """Words of a block of rows: byte bounds, row of each word and hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.low = _LOWER[data]
        inside = _IS_WORD[self.low]
        full = np.flatnonzero(np.diff(offsets))
        first, last = offsets[:-1][full], offsets[1:][full] - 1
        edge = inside.copy()
        edge[1:] &= ~inside[:-1]
        edge[first] = inside[first]
        self.start = np.flatnonzero(edge)
        edge = inside.copy()
        edge[:-1] &= ~inside[1:]
        edge[last] = inside[last]
        self.end = np.flatnonzero(edge) + 1
        self.row = np.searchsorted(offsets, self.start, "right") - 1
        self.count = np.bincount(self.row, minlength=len(offsets) - 1)
        self.first = np.concatenate([[0], np.cumsum(self.count)])
        up, down = powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_HASH[self.low] * up[:-1], out=total[1:])
        self.hash = mix64((total[self.end] - total[self.start]) * down[self.start])
        self.bytes = self.low.tobytes()

    def kgrams(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on (rows not regarded)."""
        n = max(0, len(self.hash) - k + 1)
        out = np.zeros(n, np.uint64)
        for j in range(k):
            out = out * _STEP + self.hash[j : j + n]
        return mix64(out + np.uint64(k))

    def within(self, n: int) -> np.ndarray:
        """Which words start n consecutive words of one row."""
        m = max(0, len(self.row) - n + 1)
        return self.row[:m] == self.row[n - 1 : n - 1 + m]

    def winnow(self, k: int, span: int) -> np.ndarray:
        """Words where a chosen k-gram starts: in every ``span`` consecutive words
        of a row the k-gram with the smallest hash, the rightmost on ties. Two texts
        that share ``span`` consecutive words therefore share a chosen k-gram."""
        gram, whole = self.kgrams(k), self.within(span)
        n = len(whole)
        best, at = gram[:n].copy(), np.arange(n)
        for j in range(1, span - k + 1):
            other = gram[j : j + n]
            smaller = other <= best
            best = np.where(smaller, other, best)
            at = np.where(smaller, np.arange(j, j + n), at)
        at = at[whole]
        return at[np.append(True, at[1:] != at[:-1])] if len(at) else at

    def text(self, a: int, b: int) -> bytes:
        """Words a to b, space-joined."""
        return b" ".join([self.bytes[i:j] for i, j in zip(self.start[a:b].tolist(), self.end[a:b].tolist(), strict=True)])
