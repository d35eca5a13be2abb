"""Helpers shared by the training-data operators: table reads, written
intermediate tables, bounded Bloom bitmaps and batch views of text columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.session import checkpoint_dir

# Text bytes handled by one vectorised step. A document longer than this is one
# step of its own: texts are never cut.
BLOCK_BYTES = 1 << 20


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python a few megabytes at a time: ten thousand documents, the
    usual batch, can be gigabytes, on the executor's JVM as well as in its workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet under the shared ``spark.checkpoint.dir`` and
    read it back: later plans start from files that outlive any executor."""
    spark = df.sparkSession
    small_batches(spark)
    path = f"{checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(column: Column, modulus: int) -> Column:
    """crc32 of the value's text, modulo ``modulus`` (NULL for NULL)."""
    return F.crc32(column.cast("string")) % modulus


def text_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Views ``(first row, end row, bytes, offsets)`` of consecutive rows holding
    about ``limit`` bytes; NULL counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def sums_by_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` per row, where row i owns [offsets[i], offsets[i+1])."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def mix64(x: np.ndarray) -> np.ndarray:
    """Public 64-bit finaliser (xor-shift-multiply), on uint64 arrays."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def bloom_words(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bitmap of ``2**bits`` bits with two bits set for every 64-bit key.

    Built by a shuffle of (word, mask) pairs; the driver receives at most
    2**bits / 64 words whatever the number of keys, which is the proven bound of
    the broadcast made from it. More keys only make the bitmap less selective:
    it is always followed by an exact join."""
    pos = F.explode(F.array(*[F.pmod(F.shiftrightunsigned(F.col(column), s), F.lit(1 << bits)) for s in (0, 30)]))
    rows = (
        keys.select(pos.alias("bit"))
        .select(F.shiftrightunsigned("bit", 6).alias("word"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("mask"))
        .groupBy("word").agg(F.bit_or("mask").alias("mask"))
        .toPandas()
    )
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[rows["word"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64).view(np.uint64)
    return words


def in_bloom(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which uint64 ``keys`` may be in the bitmap."""
    size = np.uint64(len(words) * 64 - 1)
    hit = np.ones(len(keys), bool)
    for s in (0, 30):
        bit = (keys >> np.uint64(s)) & size
        hit &= (words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
    return hit
