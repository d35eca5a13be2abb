"""Benchmark decontamination by winnowing.

Of every ``span`` consecutive words both sides keep the k-gram with the smallest hash,
so any shared run of ``span`` words shares a kept fingerprint. Documents send only
fingerprints that pass a bitmap of the benchmark's (bounded size), each with the
words around it; the join on the fingerprint then extends the hit word by word
to both sides, which decides exactly. Items shorter than ``span`` words are one
window of their own length n: their fingerprint is the n-gram itself (k = n, every
one kept).

Edge cases: NULL or wordless texts have no words and no hits; wordless items
never match; repeated rows are judged one by one; an empty benchmark leaves
everything clean; an item without id still hits words but is not listed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from urbanlens.llm.common import bloom_words, in_bloom, materialize, read, text_blocks
from urbanlens.llm.words import Words

SPAN = 10
GRAM = 5
BLOOM_BITS = 23
_FOUND = "array<struct<hash:bigint,pos:int,k:int,whole:boolean,before:int,words:string>>"
_WHOLE = np.uint64(0xA5A5A5A5A5A5A5A5)  # keeps hashes of whole short items apart


def _marks(words: Words, span: int, gram: int, short: range | list[int], items: bool) -> tuple[np.ndarray, ...]:
    """Fingerprints ``(first word, hash, k, whole)``: winnowed k-grams, then every
    n-gram of the short lengths (of an item only the one that is all of it)."""
    at = words.winnow(gram, span)
    out = [(at, words.kgrams(gram)[at], np.full(len(at), gram), np.zeros(len(at), bool))]
    for n in short:
        at = np.flatnonzero(words.within(n))
        if items:
            at = at[words.count[words.row[at]] == n]
        out.append((at, words.kgrams(n)[at] ^ _WHOLE, np.full(len(at), n), np.ones(len(at), bool)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _marker(span: int, gram: int, short: range | list[int], bitmap=None):
    """UDF on ``text``: its number of words and its fingerprints, each with up to
    span - gram words on either side; given a bitmap, only fingerprints in it."""

    @arrow_udf(f"struct<n:bigint,found:{_FOUND}>")
    def mark(texts: pa.Array) -> pa.Array:
        counts, per_row, out, around = [], [], [], []
        for _, _, data, offsets in text_blocks(texts):
            words = Words(data, offsets)
            counts.append(words.count)
            marks = _marks(words, span, gram, short, bitmap is None)
            if bitmap is not None:
                sure = in_bloom(bitmap.value, marks[1])
                marks = tuple(x[sure] for x in marks)
            order = np.argsort(marks[0], kind="stable")
            at, found, k, whole = (x[order] for x in marks)
            row = words.row[at]
            far = np.where(whole, 0, span - gram)
            a, b = np.maximum(at - far, words.first[row]), np.minimum(at + k + far, words.first[row + 1])
            per_row.append(np.bincount(row, minlength=len(offsets) - 1))
            out.append((found.view(np.int64), at - words.first[row], k, whole, at - a))
            around += [words.text(i, j).decode("utf-8", "replace") for i, j in zip(a.tolist(), b.tolist(), strict=True)]
        flat = lambda parts, kind: np.concatenate([*parts, np.zeros(0, kind)]).astype(kind)
        names = ["hash", "pos", "k", "whole", "before", "words"]
        kinds = [np.int64, np.int32, np.int32, bool, np.int32]
        fields = [pa.array(flat([x[i] for x in out], kind)) for i, kind in enumerate(kinds)] + [pa.array(around, pa.string())]
        ends = np.concatenate([[0], np.cumsum(flat(per_row, np.int64))]).astype(np.int32)
        found = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, names))
        return pa.StructArray.from_arrays([pa.array(flat(counts, np.int64)), found], ["n", "found"])

    return mark(F.coalesce(F.col("text"), F.lit("")))


def _agreeing(step: int, most: int) -> Column:
    """How many words before (step -1) or after (1) the fingerprint agree, ``most`` at most."""
    count = F.lit(0)
    for j in range(most - 1, -1, -1):
        near = [f"{side}.before {'-' if step < 0 else f'+ {side}.k +'} {j + (step < 0)}" for side in ("doc", "item")]
        same = F.expr(f"coalesce(get(doc.words, {near[0]}) = get(item.words, {near[1]}), false)")
        count = F.when(same, count + 1).otherwise(F.lit(0))
    return count


def contamination(docs: DataFrame, benchmark: DataFrame, carry: list[str], span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: the ``carry`` columns, ``n_words``, ``n_hit``,
    ``spans`` (word intervals, sorted) and ``items`` (ids as strings, sorted)."""
    marks = materialize(
        benchmark.select("item_id", F.explode(_marker(span, gram, range(1, span))["found"]).alias("f"))
        .select("item_id", "f.hash", F.struct("f.k", "f.whole", "f.before", F.split("f.words", " ").alias("words")).alias("item"))
        .distinct()
    )
    short = sorted(r.k for r in marks.where("item.whole").select("item.k").distinct().collect())  # below span: few values
    bitmap = docs.sparkSession.sparkContext.broadcast(bloom_words(marks, "hash", BLOOM_BITS))
    rows = (
        docs.withColumn("__row", F.monotonically_increasing_id())
        .select("__row", F.struct(*[F.col(c) for c in carry]).alias("__kept"), _marker(span, gram, short, bitmap).alias("m"))
        .select("__row", "__kept", F.col("m.n").alias("n_words"), F.explode_outer("m.found").alias("f"))
        # a document without fingerprints goes under a key of its own, not all under NULL
        .select(
            "__row", "__kept", "n_words", F.coalesce("f.hash", F.xxhash64("__row")).alias("hash"),
            F.struct("f.pos", "f.k", "f.whole", "f.before", F.split("f.words", " ").alias("words")).alias("doc"),
        )
    )
    agree = lambda step: _agreeing(step, span - gram)
    core = F.expr("doc.k = item.k and doc.whole = item.whole and slice(doc.words, doc.before + 1, doc.k) = slice(item.words, item.before + 1, item.k)")
    joined = (
        rows.join(marks, "hash", "left")
        .withColumns({"back": agree(-1), "on": agree(1)})
        .withColumn("hit", F.coalesce(core & (F.col("item.whole") | (F.col("doc.k") + F.col("back") + F.col("on") >= span)), F.lit(False)))
        .withColumn("from", F.col("doc.pos") - F.col("back"))
        .withColumn("to", F.col("doc.pos") + F.col("doc.k") + F.col("on"))
    )
    grouped = joined.groupBy("__row").agg(
        F.first("__kept").alias("__kept"), F.first("n_words").alias("n_words"),
        F.array_sort(F.collect_set(F.when(F.col("hit"), F.struct("from", "to")))).alias("spans"),
        F.array_sort(F.collect_set(F.when(F.col("hit"), F.col("item_id").cast("string")))).alias("items"),
    )
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    union = F.aggregate("spans", start, lambda s, x: F.struct(
        F.greatest(s["end"], x["to"]).alias("end"),
        (s["n"] + F.greatest(F.lit(0), x["to"] - F.greatest(s["end"], x["from"]))).alias("n"),
    ))
    return grouped.select("__kept.*", "n_words", union["n"].alias("n_hit"), "spans", "items")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with any benchmark window go."""
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id"), F.lit(0)).alias("id"), F.xxhash64("text").alias("digest"))
    keyed = docs.withColumn("__key", key)
    hit = contamination(keyed, read(spark, sf_dir, "benchmark"), ["__key"]).where("n_hit > 0").select("__key").distinct()
    return keyed.join(hit, "__key", "left_anti").select(*docs.columns)


# DuckDB: every window of every document against every window of every item.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (
  SELECT r, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS t
  FROM (SELECT r, w, k, unnest(range(1, greatest(len(w) - k + 2, 1))) AS i FROM d, ks)),
h AS (SELECT dw.r, dw.i, dw.k, iw.item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.t = iw.t),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM h)) GROUP BY r),
s AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN s USING (r)
"""
