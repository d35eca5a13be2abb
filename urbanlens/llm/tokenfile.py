"""Token-id files: documents tokenized, written in blocks of an adaptive
context-mixing range coder (see ``idcoder``), and read back.

Documents are dealt out by ranges of ascending doc_id (NULL first) and every range is
written as blocks of whole documents that reach ``BLOCK_IDS`` ids; a longer document
makes a longer block. The blocks are rows of a Parquet table (part, block,
ids before it in its part, documents, ids, payload) in the shared folder, so any store that Spark writes will do and a lost task only
rewrites its own blocks. Reading needs nothing but the payloads.

Edge cases: NULL and empty texts hold only the end id; equal ids are ordered by text;
repeated rows are each written; an empty table gives no blocks; a damaged block raises;
an added token's literal in a text (``<|endoftext|>``) is that token, as by the library's defaults.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import uuid

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urbanlens.llm.chunks import Cache, chunk_starts, distinct, gather
from urbanlens.llm.common import read, text_blocks
from urbanlens.llm.idcoder import decode_block, encode_block
from urbanlens.session import checkpoint_dir

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
BLOCK_IDS = 1 << 21
CACHED = 250_000  # chunks of a cache's generation, about 50 MB
BLOCK_BYTES = 4 << 20  # text encoded at a time: the more, the fewer chunks are looked up
_TABLE = "part int, block int, first bigint, documents bigint, ids bigint, payload binary"


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
# Byte-level vocabularies write printable bytes as themselves and the others, in order, as the characters from U+0100 on.
_PRINTED = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
_PACK = [struct.Struct(f"<{n}I").pack for n in range(32)]
_SHOWN = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in set(_PRINTED))}


class _Runs(Cache):
    """The cache with one look-up for what is young, as most is."""

    def fetch(self, names: list[bytes], make) -> list[bytes]:
        young, old = self.young, self.old
        out = list(map(young.get, names))
        missing = [i for i, run in enumerate(out) if run is None]
        new = [names[i] for i in missing if names[i] not in old]
        made = dict(zip(new, make(new), strict=True)) if new else {}
        for i in missing:
            x = names[i]
            out[i] = young[x] = made[x] if x in made else old[x]
        if len(young) > self.generation:
            self.young, self.old = {}, young
        return out


class Encoder:
    """The public tokenizer, asked once for each distinct chunk of text. It lower-cases and drops white
    space (checked), so chunks are looked up in lower case and without the blank they start with. ``plain``: literals of
    special tokens are text; else they are the tokens, as by the library's defaults."""

    def __init__(self, raw: bytes, plain: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(raw.decode("utf-8"))
        self.tokenizer.encode_special_tokens = plain
        added = [] if plain else list(self.tokenizer.get_added_tokens_decoder().values())
        if any(x.normalized or x.lstrip or x.rstrip or x.single_word for x in added):
            raise ValueError("added tokens must be matched as they are written")
        self.literals = sorted((x.content.encode() for x in added), key=len, reverse=True)
        self.literal = re.compile(b"|".join(map(re.escape, self.literals)))
        self.vocabulary = self.tokenizer.get_vocab_size()
        same = ("Aa Bb", "aa bb", "aa\nbb", " Aa  bB")
        self.folds = len({tuple(self.tokenizer.encode(x, add_special_tokens=False).ids) for x in same}) == 1
        self.cache = _Runs(CACHED)
        tried = ["word", "straße", "garçon", "łódź", "ſo", "naïveté"]
        self.model = self.tokenizer.model
        self.direct = self.folds and all(self._letters(x) == self.tokenizer.encode(x, add_special_tokens=False).ids for x in tried)

    def _letters(self, word: str) -> list[int]:
        """Ids of a word of lower-case letters below U+0180, which no step before the merges changes or splits."""
        return [x.id for x in self.model.tokenize(word if word.isascii() else word.encode().decode("latin-1").translate(_SHOWN))]

    def encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        out: list = [None] * len(chunks)
        rest, texts = [], []
        tokenize, direct = self.model.tokenize, self.direct
        for i, x in enumerate(chunks):
            if direct and x.isalpha() and x.islower():  # ASCII
                ids = [t.id for t in tokenize(x.decode("ascii"))]
            else:
                text = x.decode("utf-8")
                if not (direct and text.isalpha() and max(text) < "\u0180" and text == text.lower()):
                    rest.append(i), texts.append(text)
                    continue
                ids = self._letters(text)
            out[i] = _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        for i, x in zip(rest, found, strict=True):
            out[i] = struct.pack(f"<{len(x.ids)}I", *x.ids)
        return out

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
        """Where the rows hold literals."""
        raw = data.tobytes()
        if not any(x in raw for x in self.literals):
            return []
        return [m.span() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True) for m in self.literal.finditer(raw, a, b)]

    def encode_block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a block and their offsets per row."""
        whole = self.spans(data, offsets)
        start = chunk_starts(data, offsets, whole)
        if not len(start):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        row = np.searchsorted(start, offsets)  # first chunk of each row
        if self.folds:
            # literals are lower case themselves, and what becomes one by folding lies in several chunks
            first = data[start]
            blank = start[(first == 0x20) | (first == 0x0A)]
            kept = np.ones(len(data), bool)
            kept[blank] = False
            data = _LOWER[data][kept]
            start = start - np.searchsorted(blank, start)
        bounds = pa.py_buffer(np.append(start, len(data)).astype(np.int64))
        chunks = pa.Array.from_buffers(pa.large_binary(), len(start), [None, bounds, pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        runs = self.cache.fetch(distinct(chunks), self.encode_chunks)
        size = np.fromiter(map(len, runs), np.int64, len(runs)) // 4
        ids, ends = gather(np.cumsum(size) - size, size, np.frombuffer(b"".join(runs), "<u4"), chunks.indices.to_numpy().astype(np.int64))
        return ids, ends[row]

    def rows(self, texts: pa.Array):
        """(first row, sizes, ids) of blocks of rows, without end ids."""
        for lo, _, data, offsets in text_blocks(texts, BLOCK_BYTES):
            ids, ends = self.encode_block(data, offsets)
            yield lo, np.diff(ends), ids


_LOADED: dict[str, Encoder] = {}


def _loaded(raw: bytes) -> Encoder:
    key = hashlib.sha256(raw).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Encoder(raw, plain=False)
    return _LOADED[key]


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Tokenize ``text`` and write the blocks of all documents to ``path``."""
    spark = docs.sparkSession
    with open(tokenizer or public_tokenizers.path(TOKENIZER), "rb") as f:
        raw = spark.sparkContext.broadcast(f.read())  # one vocabulary file

    def blocks(batches):
        encoder, part, number = _loaded(raw.value), TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        sizes: list[np.ndarray] = []
        held: list[np.ndarray] = []
        count = first = 0

        def flush():
            nonlocal names, sizes, held, count, first, number
            payload = encode_block(names, np.concatenate(sizes), np.concatenate(held), max(encoder.vocabulary, end_id + 1))
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([first]), pa.array([len(names)]), pa.array([count]), pa.array([payload], pa.binary())],
                ["part", "block", "first", "documents", "ids", "payload"],
            )
            names, sizes, held, count, first, number = [], [], [], 0, first + count, number + 1
            return row

        for batch in batches:
            ids_of = batch.column("doc_id").to_pylist()
            for lo, size, ids in encoder.rows(batch.column("text")):
                ends = np.cumsum(size)
                names += ids_of[lo : lo + len(size)]
                sizes.append(size + 1)
                held.append(np.insert(ids, ends, end_id))
                count += len(ids) + len(size)
                if count >= block_ids:
                    yield flush()
        if names:
            yield flush()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    )
    ordered.mapInArrow(blocks, _TABLE).write.option("compression", "uncompressed").parquet(path)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document in the files: ``ids`` packed
    as little-endian 32-bit integers, ``start`` the number of ids before it."""
    table = spark.read.schema(_TABLE).parquet(path)
    # one row a part, and there are as many parts as shuffle partitions at writing
    parts = table.groupBy("part").agg(F.sum("ids").alias("n"))
    base = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = parts.select("part", base.alias("base"))

    def decode(batches):
        _LOADED.clear()  # what encoding left in this worker
        for batch in batches:
            for i in range(batch.num_rows):
                names, sizes, ids = decode_block(batch.column("payload")[i].as_py())
                ends = np.cumsum(sizes)
                packed, at = ids.astype("<u4"), 0
                while at < len(names):  # a few megabytes of documents at a time
                    first = int(ends[at - 1]) if at else 0
                    to = max(at + 1, int(np.searchsorted(ends, first + (1 << 20), "right")))
                    offsets = (np.concatenate([[first], ends[at:to]]) - first) * 4
                    run = pa.Array.from_buffers(pa.binary(), to - at, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(packed[first : int(ends[to - 1])].tobytes())])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(to - at, batch.column("part")[i].as_py(), np.int32)), pa.array(names[at:to], pa.int64()),
                        pa.array(ends[at:to] - sizes[at:to] + batch.column("first")[i].as_py()), pa.array(sizes[at:to]), run,
                    ], ["part", "doc_id", "at", "n_tokens", "ids"])
                    at = to

    found = table.select("part", "first", "payload").mapInArrow(decode, "part int, doc_id bigint, at bigint, n_tokens bigint, ids binary")
    return found.join(F.broadcast(before), "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark)}/token-ids-{uuid.uuid4().hex}"
    write(read(spark, sf_dir, "documents"), path)
    return read_back(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
