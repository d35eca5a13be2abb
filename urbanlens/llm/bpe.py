"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Every pre-token is a linked list of byte runs. Each merge rank has a bucket of list
positions whose pair has that rank (a heap, as the leftmost comes first); two levels of 256-bit
bitmaps mark the buckets in use, and find-first-set down the levels gives the smallest rank.
Entries whose pair has changed since are skipped when they surface. A pre-token of n bytes
takes O(n) queue steps of O(log n) each whatever its length, and no scan over its pairs.
Up to ``SHORT`` bytes a bucket is a bitmap of positions, a third level: find-first-set gives the leftmost
too, and a pair that changes leaves its bucket at once.

Edge cases: NULL and empty text encode to no ids; repeated rows encode alike;
other columns pass through. Ids are packed little-endian 32-bit integers.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from heapq import heappop, heappush
from itertools import repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from urbanlens.llm.chunks import Cache, encode_rows, gather
from urbanlens.llm.common import read, small_batches, text_blocks

RANK_FILE = "byte_bpe_multi_50k.tiktoken"


BIT = [1 << i for i in range(1024)]
SHORT = 240  # bytes of a pre-token whose positions fit a bitmap of a few words


class Bpe:
    """Ranks of one vocabulary file, with a bounded cache of what was encoded."""

    def __init__(self, raw: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}
        self.longest = max(map(len, self.ranks))
        count = max(self.ranks.values()) + 1
        # a bucket is None, one position or a heap of positions; all are empty between merges
        self.buckets: list[int | list[int] | None] = [None] * count
        self.low = [0] * (count // 256 + 1)
        if len(self.low) > len(BIT):
            raise ValueError("more ranks than two levels of bitmaps hold")
        # the same for short pre-tokens: a bitmap of positions, and a rank's bit on both levels
        self.places = [0] * count
        self.low_bit, self.top_bit = [BIT[r & 255] for r in range(count)], [BIT[r >> 8] for r in range(count)]
        self.pairs = {tuple(a): r for a, r in self.ranks.items() if len(a) == 2}
        # white space by its Unicode property, as the public encoder has it
        self.pattern = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))
        self.chunks = Cache()
        tokens = sorted((b, a) for a, b in self.ranks.items())
        size = np.zeros(tokens[-1][0] + 1, np.int64)
        size[[b for b, _ in tokens]] = [len(a) for _, a in tokens]
        self.size, self.start = size, np.cumsum(size) - size
        self.bytes = np.frombuffer(b"".join(a for _, a in tokens), np.uint8)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token. The queue's steps are written out: calls would double the time."""
        ranks, longest, bit = self.ranks, self.longest, BIT
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) <= SHORT:
            return self.merge_short(piece)
        n, find, buckets, low, top = len(piece), ranks.get, self.buckets, self.low, 0
        after, before = list(range(1, n + 2)), list(range(-1, n))
        pair = [find(piece[i : i + 2], -1) for i in range(n - 1)]
        todo = list(enumerate(pair))  # positions to enter into their buckets
        pair += (-1, -1)
        while True:
            for at, rank in todo:
                if rank >= 0:
                    held = buckets[rank]
                    if held is None:
                        buckets[rank] = at
                        word = rank >> 8
                        low[word] |= bit[rank & 255]
                        top |= bit[word]
                    elif held.__class__ is int:
                        buckets[rank] = [held, at] if held < at else [at, held]
                    else:
                        heappush(held, at)
            todo = []
            if not top:
                break
            word = (top & -top).bit_length() - 1
            bits = low[word]
            rank = (word << 8) + (bits & -bits).bit_length() - 1
            held = buckets[rank]
            i = held if held.__class__ is int else heappop(held)
            if i is held or not held:
                buckets[rank] = None
                low[word] = bits = bits & (bits - 1)
                if not bits:
                    top &= top - 1
            if pair[i] != rank:
                continue  # stale
            j = after[i]
            k = after[j]
            after[i] = k
            before[k] = i
            pair[j] = -1
            end = after[k] if k < n else n + longest + 1
            pair[i] = rank = find(piece[i:end], -1) if end - i <= longest else -1
            todo.append((i, rank))
            if i:
                p = before[i]
                rank = find(piece[p:k], -1) if k - p <= longest else -1
                if rank != pair[p]:
                    pair[p] = rank
                    todo.append((p, rank))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def merge_short(self, piece: bytes) -> list[int]:
        """The same for at most ``SHORT`` bytes, with positions as bits of their bucket."""
        ranks, places, low, bit, low_bit, top_bit = self.ranks, self.places, self.low, BIT, self.low_bit, self.top_bit
        n, find, top = len(piece), ranks.get, 0
        after, before = list(range(1, n + 2)), list(range(-1, n))
        pair = list(map(self.pairs.get, zip(piece, piece[1:]), repeat(-1)))
        for at, rank in enumerate(pair):
            if rank >= 0:
                held = places[rank]
                places[rank] = held | bit[at]
                if not held:
                    low[rank >> 8] |= low_bit[rank]
                    top |= top_bit[rank]
        pair += (-1, -1)
        while top:
            word = (top & -top).bit_length() - 1
            bits = low[word]
            rank = (word << 8) + (bits & -bits).bit_length() - 1
            held = places[rank]
            here = held & -held
            i = here.bit_length() - 1
            places[rank] = held = held ^ here
            if not held:
                low[word] = bits = bits & (bits - 1)
                if not bits:
                    top &= top - 1
            j = after[i]
            k = after[j]
            after[i] = k
            before[k] = i
            gone = pair[j]
            if gone >= 0:
                places[gone] = held = places[gone] ^ bit[j]
                if not held:
                    low[gone >> 8] = bits = low[gone >> 8] ^ low_bit[gone]
                    if not bits:
                        top ^= top_bit[gone]
            pair[i] = rank = find(piece[i : after[k]], -1) if k < n else -1
            if rank >= 0:
                held = places[rank]
                places[rank] = held | here
                if not held:
                    low[rank >> 8] |= low_bit[rank]
                    top |= top_bit[rank]
            if i:
                p = before[i]
                gone, rank = pair[p], find(piece[p:k], -1)
                if rank != gone:
                    pair[p] = rank
                    if gone >= 0:
                        places[gone] = held = places[gone] ^ bit[p]
                        if not held:
                            low[gone >> 8] = bits = low[gone >> 8] ^ low_bit[gone]
                            if not bits:
                                top ^= top_bit[gone]
                    if rank >= 0:
                        held = places[rank]
                        places[rank] = held | bit[p]
                        if not held:
                            low[rank >> 8] |= low_bit[rank]
                            top |= top_bit[rank]
        out, i = [], 0
        while i < n:
            j = after[i]
            out.append(ranks[piece[i:j]])
            i = j
        return out

    def encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        find, merge, out = self.pattern.findall, self.merge, []
        for chunk in chunks:
            ids: list[int] = []
            for piece in find(chunk.decode("utf-8")):
                ids += merge(piece.encode("utf-8"))
            out.append(array("I", ids).tobytes())
        return out

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return gather(self.start, self.size, self.bytes, ids.astype(np.int64))


_LOADED: dict[str, Bpe] = {}


def _loaded(raw: bytes, pattern: str) -> Bpe:
    """One vocabulary per Python worker, by content."""
    key = hashlib.sha256(raw + pattern.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Bpe(raw, pattern)
    return _LOADED[key]


def _shared(spark: SparkSession, path: str):
    """The vocabulary file (about a megabyte, whatever the corpus), broadcast."""
    small_batches(spark)
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _packed(ids: list[np.ndarray], sizes: list[np.ndarray]) -> pa.Array:
    data = np.concatenate([*ids, np.zeros(0, ids[0].dtype if ids else np.uint8)])
    ends = np.concatenate([[0], np.cumsum(np.concatenate([*sizes, np.zeros(0, np.int64)]))]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def with_ids(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN, name: str = "ids") -> DataFrame:
    """Add the packed ids of column ``text``."""
    raw = _shared(docs.sparkSession, path or public_tokenizers.path(RANK_FILE))

    @arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        bpe, ids, sizes = _loaded(raw.value, pattern), [], []
        for _, _, data, offsets in text_blocks(texts):
            found, ends = encode_rows(data, offsets, bpe.chunks, bpe.encode_chunks)
            ids.append(found.view(np.uint8)), sizes.append(np.diff(ends) * 4)
        return _packed(ids, sizes)

    return docs.withColumn(name, encode(F.coalesce(F.col("text"), F.lit(""))))


def with_decoded(encoded: DataFrame, path: str | None = None, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the bytes that the packed ids stand for."""
    raw = _shared(encoded.sparkSession, path or public_tokenizers.path(RANK_FILE))

    @arrow_udf("binary")
    def decode(packed: pa.Array) -> pa.Array:
        bpe, out, sizes = _loaded(raw.value, public_tokenizers.PATTERN), [], []
        for _, _, data, offsets in text_blocks(packed.cast(pa.large_binary())):
            text, ends = bpe.decode(data.view("<u4") if data.flags.aligned else np.frombuffer(data.tobytes(), "<u4"))
            out.append(text), sizes.append(np.diff(ends[offsets // 4]))
        return _packed(out, sizes)

    return encoded.withColumn(name, decode(F.col(ids)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = with_decoded(with_ids(read(spark, sf_dir, "documents").select("doc_id", "text")))
    return both.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: ids of every document, proven by decoding them."""
    both = with_decoded(with_ids(docs))
    same = F.coalesce(F.col("text"), F.lit("")).cast("binary") == F.col("decoded")
    return both.select(
        "doc_id", "lang", "source", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.when(same, F.col("ids")).otherwise(F.raise_error(F.lit("decoding gave other text"))).alias("ids"),
    )
