"""SimHash near-duplicates through a byte-position inverted index.

A 64-bit fingerprint has eight positional bytes. Two fingerprints that differ in
at most three bits agree in at least five of them: that is the guaranteed minimum
match count. Postings of single bytes would be long, so the index lists four
positional bytes at a time. The lists are the fourteen 4-subsets of {0..7}
whose members xor to zero (the planes of a 3-cube): any three positions lie inside
one such plane, hence its complement, also a plane, holds only agreeing bytes and
every pair within distance 3 meets in at least one list.

Inside a list the shared positional bytes of a pair are tallied; pairs that reach
five are verified by Hamming distance. Only a spanning forest of each list leaves
the task, so a list of m members yields at most m - 1 links, not m^2. Lists longer than
``LONG_LIST`` are split by a fifth agreeing byte (a pair shares at least one more), which
bounds what a task can hold by the 2^24 values of the remaining three bytes.

Edge cases: NULL or blank text has fingerprint 0 and links like any other;
repeated rows share their component; NULL doc_ids never become a component id
while another id is reachable; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from urbanlens.llm.common import materialize, read, text_blocks
from urbanlens.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
LONG_LIST = 4096
PLANES = [c for c in combinations(range(8), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]


def simhash(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one text (signed 64-bit)."""
    parts = text.lower().split()  # bytes: folds A-Z only, splits on \x20 \x09-\x0D
    if not parts:
        return 0
    joined = b" ".join(parts)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    end = np.cumsum(size + 1) - 1
    start = end - size
    k = min(words, len(parts))
    digest = xxhash.xxh64_digest
    cut = [digest(joined[a:b], SEED) for a, b in zip(start[: len(start) - k + 1].tolist(), end[k - 1 :].tolist(), strict=True)]
    ones, step = np.zeros(64, np.int64), 1 << 14
    for at in range(0, len(cut), step):
        part = np.frombuffer(b"".join(cut[at : at + step]), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(cut)).tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, words: int = SHINGLE_WORDS, name: str = "fp") -> DataFrame:
    """Add the SimHash of column ``text`` as a long."""

    @arrow_udf("bigint")
    def fingerprint(texts: pa.Array) -> pa.Array:
        out = []
        for _, _, data, offsets in text_blocks(texts):
            raw = data.tobytes()
            out += [simhash(raw[a:b], words) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        return pa.array(out, pa.int64())

    return docs.withColumn(name, fingerprint(F.coalesce(F.col("text"), F.lit(""))))


def _byte(column, at: int):
    return F.shiftrightunsigned(column, 8 * at).bitwiseAND(F.lit(255))


def postings(fps: DataFrame) -> DataFrame:
    """``(list, bytes, fp)``: one row per plane of each distinct fingerprint."""
    fp = F.col("fp")
    rows = []
    for number, plane in enumerate(PLANES):
        packed = F.lit(0).cast("long")
        for at in plane:
            packed = packed * 256 + _byte(fp, at)
        rows.append(F.struct(F.lit(number).alias("list"), packed.alias("bytes")))
    return fps.select("fp", F.explode(F.array(*rows)).alias("k")).select("k.list", "k.bytes", "fp")


def split_long_lists(index: DataFrame, longest: int) -> DataFrame:
    """Give each list a further key: 0, or for lists over ``longest`` each of the four remaining positions with its byte."""
    sizes = index.groupBy("list", "bytes").agg(F.count(F.lit(1)).alias("n"))
    rest = ", ".join(f"array({', '.join(str(p) for p in range(8) if p not in plane)})" for plane in PLANES)
    fifth = F.expr(f"transform(element_at(array({rest}), list + 1), p -> (p + 1) * 256L + (shiftrightunsigned(fp, p * 8) & 255L))")
    return (
        index.join(sizes.where("n > 1"), ["list", "bytes"])
        .select("list", "bytes", "fp", F.explode(F.when(F.col("n") > longest, fifth).otherwise(F.array(F.lit(0).cast("long")))).alias("more"))
    )


def _forest(fps: np.ndarray, bits: int) -> tuple[list[int], list[int]]:
    """Spanning forest of the links (at most ``bits`` differing bits, at least 8 - bits equal bytes) among ``fps``."""
    src, dst = [], []
    left = fps
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            differ = left ^ x
            bytes_equal = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(1)
            near = bytes_equal >= 8 - bits
            near[near] = np.bitwise_count(differ[near]) <= bits
            if near.any():
                found = left[near]
                src += [int(x)] * len(found)
                dst += found.tolist()
                todo += list(found)
                left = left[~near]
    return src, dst


def links(fps: DataFrame, bits: int = MAX_BITS, longest: int = LONG_LIST) -> DataFrame:
    """Links ``(src, dst)`` between distinct fingerprints that connect exactly
    those joined by chains of at most ``bits`` (3 at most) differing bits."""
    if not 0 <= bits <= MAX_BITS:
        raise ValueError("the index guarantees matches up to 3 bits")

    def pairs(batches):
        for batch in batches:
            src, dst = [], []
            for members in batch.column(0):
                a, b = _forest(np.unique(members.values.to_numpy()).view(np.uint64), bits)
                src += a
                dst += b
            yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (src, dst)], ["src", "dst"])

    lists = (
        split_long_lists(postings(fps), longest)
        .groupBy("list", "bytes", "more").agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1).select("fps")
    )
    return lists.mapInArrow(pairs, "src bigint, dst bigint")


def components(docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row of ``docs``."""
    marked = materialize(with_fingerprint(docs.select("doc_id", "text"), words).select("doc_id", "fp"))
    fps = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = connected_components(links(fps.select("fp"), bits))
    rooted = fps.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(rooted.select("fp", "root").join(ids, "root").select("fp", "component_id"), "fp")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = components(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near copies the document with the
    smallest doc_id stays (of rows that repeat that id, the least text; rows
    without an id stay only if no row of the group has one)."""
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id"), F.lit(0)).alias("id"))
    found = components(docs)
    keep = found.where("doc_id <=> component_id").select(key.alias("__key")).distinct()
    rest = [c for c, kind in docs.dtypes if c not in ("doc_id", "text") and not kind.startswith(("map", "array", "struct", "variant"))]
    first = Window.partitionBy("__key").orderBy("text", *rest)  # on the join's own partitioning
    return (
        docs.withColumn("__key", key).join(keep, "__key", "left_semi")
        .withColumn("__nth", F.row_number().over(first)).where("__nth = 1").select(*docs.columns)
    )
