"""Cuts texts into short chunks at blanks, so that a tokenizer sees each distinct
chunk once and the ids of whole texts are gathered by array operations.

A cut is made before a lone space and on both sides of a lone newline, where the
characters next to it are not white space, and between an ASCII letter and an ASCII
punctuation mark. No match of the tokenizers' patterns can span such a place, and what matches there does not depend on the other side,
so the ids of the chunks, joined, are the ids of the text.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa



class Cache:
    """Remembers at most two generations of ``generation`` entries (about 200 bytes each);
    what is used again moves to the young one, the rest goes when that is full."""

    def __init__(self, generation: int = 400_000):
        self.generation = generation
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def fetch(self, names: list[bytes], make: Callable[[list[bytes]], list[bytes]]) -> list[bytes]:
        young, old = self.young, self.old
        new = [x for x in names if x not in young and x not in old]
        made = dict(zip(new, make(new), strict=True)) if new else {}
        out = []
        for x in names:
            run = young.get(x)
            if run is None:
                run = young[x] = made[x] if x in made else old[x]
            out.append(run)
        if len(young) > self.generation:
            self.young, self.old = {}, young
        return out


def chunk_starts(data: np.ndarray, offsets: np.ndarray, whole: list[tuple[int, int]] | None = None) -> np.ndarray:
    """Byte positions where chunks start (each non-empty row starts one). Each span of ``whole`` is a chunk."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 2:
        b = data
        ascii_blank = (b == 0x20) | ((b >= 0x09) & (b <= 0x0D)) | ((b >= 0x1C) & (b <= 0x1F))
        # white space beyond ASCII starts with C2, E1, E2 or E3; other leads are safe
        unsafe_lead = (b == 0xC2) | ((b >= 0xE1) & (b <= 0xE3))
        wide = b >= 0x80
        # does the character that ends here belong to a safe one?
        ends_safe = ~ascii_blank & ~wide
        lead2 = (b >= 0xC3) & (b <= 0xDF)
        lead3 = (b == 0xE0) | ((b >= 0xE4) & (b <= 0xEF))
        lead4 = b >= 0xF0
        tail = (b & 0xC0) == 0x80
        ends_safe[1:] |= lead2[:-1] & tail[1:]
        ends_safe[2:] |= lead3[:-2] & tail[1:-1] & tail[2:]
        ends_safe[3:] |= lead4[:-3] & tail[1:-2] & tail[2:-1] & tail[3:]
        starts_safe = ~ascii_blank & ~unsafe_lead & ~tail
        first = np.zeros(n, bool)
        first[offsets[:-1][offsets[:-1] < n]] = True
        # positions 1 .. n-2 with a safe character on either side, in the same row
        alone = ends_safe[:-2] & starts_safe[2:] & ~first[1:-1] & ~first[2:]
        space = alone & (b[1:-1] == 0x20)
        line = alone & (b[1:-1] == 0x0A)
        cut[1 : n - 1] |= space | line
        cut[2:n] |= line
        fold = b | 0x20
        letter = (fold >= 0x61) & (fold <= 0x7A)
        mark = ~wide & (b > 0x20) & (b != 0x7F) & ~letter & ~((b >= 0x30) & (b <= 0x39))
        cut[1:n] |= letter[:-1] & mark[1:]
    for a, b in whole or ():
        cut[a + 1 : b] = False
        cut[a] = cut[b] = True
    cut[offsets[:-1]] = True
    return np.flatnonzero(cut[:n])


def distinct(chunks: pa.DictionaryArray) -> list[bytes]:
    """The dictionary's values, cut from its buffers: a scalar for each would take longer than finding them."""
    names = chunks.dictionary
    if not len(names):
        return []
    _, bounds, data = names.buffers()
    ends = np.frombuffer(bounds, np.int64)[names.offset : names.offset + len(names) + 1].tolist()
    raw = data.to_pybytes() if data is not None else b""
    return [raw[a:b] for a, b in zip(ends, ends[1:])]


def gather(starts: np.ndarray, lengths: np.ndarray, values: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the runs ``values[starts[c] : starts[c] + lengths[c]]`` of all codes;
    also the offsets of each code's run in the result."""
    size = lengths[codes]
    ends = np.concatenate([[0], np.cumsum(size)])
    index = np.arange(ends[-1]) + np.repeat(starts[codes] - ends[:-1], size)
    return values[index], ends


def encode_rows(data: np.ndarray, offsets: np.ndarray, cache: Cache, encode: Callable[[list[bytes]], list[bytes]], whole: list[tuple[int, int]] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows of a block and their offsets per row. ``encode`` turns chunks
    into packed little-endian 32-bit ids; ``cache`` remembers them."""
    rows = len(offsets) - 1
    start = chunk_starts(data, offsets, whole)
    if not len(start):
        return np.zeros(0, "<u4"), np.zeros(rows + 1, np.int64)
    bounds = pa.py_buffer(np.append(start, len(data)).astype(np.int64))
    chunks = pa.Array.from_buffers(pa.large_binary(), len(start), [None, bounds, pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
    names, codes = distinct(chunks), chunks.indices.to_numpy().astype(np.int64)
    runs = cache.fetch(names, encode)
    size = np.fromiter(map(len, runs), np.int64, len(runs)) // 4
    ids, ends = gather(np.cumsum(size) - size, size, np.frombuffer(b"".join(runs), "<u4"), codes)
    return ids, ends[np.searchsorted(start, offsets)]
