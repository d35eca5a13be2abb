"""Adaptive context-mixing range coder for blocks of token ids.

A block is cut into lanes that are coded side by side with one shared model. For
each id the model mixes three predictions: the id last seen after the two preceding ids
(order 2), the id last seen after the preceding one (order 1), both with a
confidence, and the adaptive frequencies of ids that neither foretold (order 0):

    P(x) = w2(s) [x = order-2 id] + w1(s) [x = order-1 id] + w0(s) P0(x)

The weights belong to the state s of the two confidences and whether both foretell the
same id; they are counted as coding goes on. The mixed interval drives a 64-bit
range coder without carries that sends 32 bits at a time. Everything is reset at the start of
a block, so blocks decode independently; a block carries a CRC-32 of its content.

Layout (little endian): magic, crc32 of the rest, vocabulary, documents, ids, lanes,
then per document its id, a flag for NULL and its number of ids, then the number of
32-bit words of each lane, then the words.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"CMR2"
_HEAD = struct.Struct("<4sIIIQI")
HASH_BITS = 18
MOST_LANES = 16_384
STEPS = 256
_W = np.uint64(32)
_LOW32 = np.uint64(0xFFFFFFFF)


class Model:
    """Tables shared by the lanes of a block; the coder and the decoder drive it alike."""

    def __init__(self, vocabulary: int, lanes: int):
        self.vocabulary, self.bits = vocabulary, max(18, (vocabulary - 1).bit_length() + 2)
        self.order2 = np.zeros(1 << HASH_BITS, np.uint32)  # id << 3 | confidence
        self.order1 = np.zeros(vocabulary, np.uint32)
        self.last, self.before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.seen = np.zeros((128, 3), np.int64)  # counts in units of 2^-16; integers, so that every machine decodes alike
        self.seen += (26_214, 13_108, 26_214)
        self.order0 = np.zeros(vocabulary, np.int64)
        self.step = 0
        self._weigh()
        self._refresh()

    def _weigh(self) -> None:
        f = np.maximum(1, self.seen * 65_000 // self.seen.sum(1, keepdims=True))
        f[:, 2] = 65536 - f[:, 0] - f[:, 1]
        self.size = f.astype(np.uint64).ravel()
        self.start = (np.cumsum(f, axis=1) - f).astype(np.uint64).ravel()

    def _refresh(self) -> None:
        total = max(1, int(self.order0.sum()))
        room = (1 << self.bits) - self.vocabulary
        f = 1 + self.order0 * room // total
        f[int(f.argmax())] += (1 << self.bits) - int(f.sum())
        self.freq0 = f.astype(np.uint64)
        self.cum0 = (np.cumsum(f) - f).astype(np.uint64)
        self._slots = None

    def slots(self) -> np.ndarray:
        """The id of each unit of the order-0 frequencies (for decoding)."""
        if self._slots is None:
            self._slots = np.repeat(np.arange(self.vocabulary), self.freq0.astype(np.int64))
        return self._slots

    def predict(self) -> None:
        self.at2 = ((self.last * 0x9E3779B1 + self.before * 0x85EBCA6B) >> 7) & ((1 << HASH_BITS) - 1)
        self.e2, self.e1 = self.order2.take(self.at2), self.order1.take(self.last)
        self.id2, self.id1 = self.e2 >> 3, self.e1 >> 3
        self.same = self.id1 == self.id2
        self.k2, self.k1 = self.e2 & 7, self.e1 & 7
        self.state = ((self.k2 << 4) | (self.k1 << 1) | self.same).astype(np.int64) * 3

    def update(self, ids: np.ndarray, which: np.ndarray, escaped: np.ndarray) -> None:
        """``which``: 0, 1, 2 for foretold by order 2, by order 1, by neither."""
        packed = (ids.astype(np.uint32) << 3) | 1
        hit2 = which == 0
        hit1 = (which == 1) | (hit2 & self.same)
        for table, at, e, k, hit in ((self.order2, self.at2, self.e2, self.k2, hit2), (self.order1, self.last, self.e1, self.k1, hit1)):
            # a hit adds confidence; a miss halves it, and below 2 the id is replaced
            table[at] = np.where(hit, e + (k < 7), np.where(k > 1, e - ((k + 1) >> 1), packed))
        self.seen += np.bincount(self.state + which, minlength=384).reshape(128, 3) << 16
        if len(escaped):
            self.order0 += np.bincount(escaped, minlength=self.vocabulary)
        self.step += 1
        self.before, self.last = self.last, ids
        if self.step < 16 or self.step % 16 == 0:
            self._refresh()
        self._weigh()
        self.seen -= self.seen // 50


def _narrow(low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lanes whose range is below 2^32: cut it at the next multiple of 2^32, if it runs over one."""
    need = np.flatnonzero(size < np.uint64(1 << 32))
    at, g = low[need], size[need]
    over = ((at ^ (at + (g - np.uint64(1)))) >> _W) != 0
    return need, at, np.where(over, (~at + np.uint64(1)) & _LOW32, g)


def _lanes(n: int) -> int:
    return min(MOST_LANES, max(1, n // STEPS))


def _encode_ids(ids: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """(words per lane, words lane by lane)."""
    lanes = _lanes(len(ids))
    steps = -(-len(ids) // lanes)
    grid = np.zeros(lanes * steps, np.uint32)
    grid[: len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model = Model(vocabulary, lanes)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    words, owners = [], []
    for row in grid:
        x = row.astype(np.int64)
        model.predict()
        which = np.where(model.id2 == x, 0, np.where(model.id1 == x, 1, 2))
        at = model.state + which
        unit = size >> np.uint64(16)
        low += unit * model.start.take(at)
        size = unit * model.size.take(at)
        rest = np.flatnonzero(which == 2)
        xr = x.take(rest)
        unit = size.take(rest) >> np.uint64(model.bits)
        low[rest] += unit * model.cum0.take(xr)
        size[rest] = unit * model.freq0.take(xr)
        need, at_low, g = _narrow(low, size)
        words.append((at_low >> _W).astype(np.uint32)), owners.append(need.astype(np.uint16))
        low[need], size[need] = at_low << _W, g << _W
        model.update(x, which, xr)
    everyone = np.arange(lanes, dtype=np.uint16)
    words += [(low >> _W).astype(np.uint32), (low & _LOW32).astype(np.uint32)]
    owners += [everyone, everyone]
    owner = np.concatenate(owners)
    return np.bincount(owner, minlength=lanes), np.concatenate(words)[np.argsort(owner, kind="stable")]


def _decode_ids(count: np.ndarray, words: np.ndarray, n: int, vocabulary: int) -> np.ndarray:
    lanes = len(count)
    steps = -(-n // lanes)
    grid = np.empty((steps, lanes), np.uint32)
    model = Model(vocabulary, lanes)
    at = np.cumsum(count) - count
    words = words.astype(np.uint64)
    code = (words[at] << _W) | words[at + 1]
    at = at + 2
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    for t in range(steps):
        model.predict()
        unit = size >> np.uint64(16)
        v = (code - low) // unit
        which = (v >= model.start.take(model.state + 1)).astype(np.int64) + (v >= model.start.take(model.state + 2))
        x = np.where(which == 0, model.id2, model.id1).astype(np.int64)
        s = model.state + which
        low += unit * model.start.take(s)
        size = unit * model.size.take(s)
        rest = np.flatnonzero(which == 2)
        unit = size.take(rest) >> np.uint64(model.bits)
        v = np.minimum((code.take(rest) - low.take(rest)) // unit, np.uint64((1 << model.bits) - 1))
        xr = model.slots().take(v.astype(np.int64))
        x[rest] = xr
        low[rest] += unit * model.cum0.take(xr)
        size[rest] = unit * model.freq0.take(xr)
        need, at_low, g = _narrow(low, size)
        low[need], size[need] = at_low << _W, g << _W
        code[need] = (code[need] << _W) | words.take(at[need], mode="clip")
        at[need] += 1
        grid[t] = x
        model.update(x, which, xr)
    return grid.T.ravel()[:n]


def encode_block(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray, vocabulary: int) -> bytes:
    """One block of whole documents."""
    count, words = _encode_ids(ids, vocabulary) if len(ids) else (np.zeros(0, np.int64), np.zeros(0, np.uint32))
    body = b"".join((
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(), np.array([x is None for x in doc_ids], np.uint8).tobytes(),
        np.asarray(sizes, "<u8").tobytes(), count.astype("<u4").tobytes(), words.astype("<u4").tobytes(),
    ))
    head = _HEAD.pack(MAGIC, 0, vocabulary, len(doc_ids), len(ids), len(count))
    return MAGIC + struct.pack("<I", zlib.crc32(body, zlib.crc32(head[8:]))) + head[8:] + body


def decode_block(raw: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc_ids, sizes, ids); ValueError if the block is damaged."""
    magic, crc, vocabulary, docs, n, lanes = _HEAD.unpack_from(raw) if len(raw) >= _HEAD.size else (b"",) * 6
    if magic != MAGIC or zlib.crc32(raw[8:]) != crc:
        raise ValueError("damaged block")
    at = _HEAD.size
    parts = []
    for kind, k in (("<i8", docs), (np.uint8, docs), ("<u8", docs), ("<u4", lanes)):
        parts.append(np.frombuffer(raw, kind, k, at))
        at += parts[-1].nbytes
    ids = _decode_ids(parts[3].astype(np.int64), np.frombuffer(raw, "<u4", offset=at), n, vocabulary) if n else np.zeros(0, np.uint32)
    return [None if null else int(x) for x, null in zip(parts[0], parts[1], strict=True)], parts[2].astype(np.int64), ids
