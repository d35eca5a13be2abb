"""Document fingerprints by winnowing, in DataFrame functions only.

Words (lower-cased, split at white space) are hashed, rolled into k-gram hashes,
and of every ``WINDOW`` consecutive k-grams the smallest hash is kept, the rightmost
on ties, with its position. Two texts that share ``GRAM + WINDOW - 1`` words in a row
share a kept hash. A kept entry is packed into one long: 33 bits of hash above
30 bits that fall as the position grows, so that the plain minimum picks the
rightmost of equal hashes.

Edge cases: texts shorter than a k-gram have one entry for all their words,
texts shorter than a window one entry; wordless and NULL texts have none, and
two empty fingerprints are alike (1.0). Equal texts have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urbanlens.llm.common import read

GRAM = 4  # a power of two
WINDOW = 8  # a power of two
_LOW = (1 << 30) - 1


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the kept entries (packed, in text order) of column ``text``."""
    words, rolled, entries = f"__{name}_w", f"__{name}_h", f"__{name}_e"
    keep = [c for c in df.columns if c != name]
    df = df.withColumn(words, F.expr(f"filter(split(lower({text}), '[ \\\\t-\\\\r]+'), w -> w <> '')"))
    df = df.withColumn(rolled, F.expr(f"transform({words}, w -> xxhash64(w))"))
    step = 1
    while step < GRAM:
        df = df.withColumn(rolled, F.expr(f"if(size({words}) >= {GRAM}, zip_with(slice({rolled}, 1, size({rolled}) - {step}), slice({rolled}, {step + 1}, size({rolled})), (a, b) -> xxhash64(a, b)), {rolled})"))
        step *= 2
    df = df.withColumn(rolled, F.expr(f"if(size({words}) < {GRAM} and size({words}) > 0, array(xxhash64({words})), {rolled})"))
    df = df.withColumn(entries, F.expr(f"transform({rolled}, (h, i) -> shiftleft(shiftrightunsigned(h, 31), 30) | ({_LOW} - i))"))
    step = 1
    while step < WINDOW:
        df = df.withColumn(entries, F.expr(f"zip_with({entries}, slice({entries}, {step + 1}, size({entries})), (a, b) -> least(a, b))"))
        step *= 2
    return df.withColumn(name, F.expr(f"array_distinct(slice({entries}, 1, greatest(1, size({entries}) - {WINDOW - 1})))")).select(*keep, name)


def hashes(entries: str) -> Column:
    return F.expr(f"array_distinct(transform({entries}, e -> shiftrightunsigned(e, 30)))")


def positions(entries: str) -> Column:
    """Word positions of the kept k-grams."""
    return F.expr(f"transform({entries}, e -> cast({_LOW} - (e & {_LOW}) as int))")


def digest(entries: str) -> Column:
    """Text form of a fingerprint: SHA-256 of its entries."""
    return F.sha2(F.array_join(F.transform(entries, lambda e: F.hex(e)), ","), 256)


def likeness(a: str, b: str) -> Column:
    """Jaccard likeness of two arrays of distinct hashes."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both / F.greatest(F.lit(1.0), F.size(a) + F.size(b) - both))


def ordered_ranges(docs: DataFrame, per_task: int = 4) -> DataFrame:
    """Add ``__key`` (doc_id, NULL below all) and ``__range``: consecutive ranges of
    descending ids of about equal size, ``per_task`` for each shuffle partition."""
    spark = docs.sparkSession
    count = per_task * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.withColumn("__key", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))))
    cuts = F.percentile_approx("doc_id", [i / count for i in range(1, count)], 10 * count)
    bounds = docs.select(cuts.alias("b")).first().b or []  # as many values as there are ranges
    bounds = sorted({int(x) for x in bounds}, reverse=True)
    above = F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in bounds]), lambda b: b > F.col("__key"))) if bounds else F.lit(0)
    return keyed.withColumn("__range", above)


def with_next(docs: DataFrame) -> DataFrame:
    """``docs`` dealt out by ranges of ids, with a fingerprint ``fp`` of ``text`` and the
    following document's text and fingerprint (``next_text``, ``next_fp``), in
    descending doc_id, the first after the last; equal ids follow by text.

    Each range also receives a copy of the first document of the following range, so
    no task needs more than its own range."""
    ranged = ordered_ranges(docs)
    heads = ranged.groupBy("__range").agg(F.max("__key").alias("__key"))  # one row per range
    # a few rows per shuffle partition: their order may go through one task
    line = Window.orderBy("__range")
    into = F.coalesce(F.lag("__range").over(line), F.max("__range").over(Window.partitionBy()))
    copies = heads.select(into.alias("__into"), "__key")
    extra = ranged.drop("__range").join(F.broadcast(copies), "__key").select(*docs.columns, "__key", F.col("__into").alias("__range"), F.lit(1).alias("__extra"))
    rows = ranged.withColumn("__extra", F.lit(0)).unionByName(extra)
    dealt = with_fingerprint(rows.repartition("__range"), "text", "fp")
    order = Window.partitionBy("__range").orderBy("__extra", F.desc("__key"), "text")
    return (
        dealt.withColumns({"next_text": F.lead("text").over(order), "next_fp": F.lead("fp").over(order)})
        .where("__extra = 0").drop("__range", "__extra", "__key")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = F.length("text")
    edited = F.concat(F.expr("left(text, length(text) - length(text) div 2)"), F.expr("left(next_text, length(text) div 2)"))
    rows = with_fingerprint(with_next(docs).withColumns({"n_chars": size.cast("long"), "edited": edited}), "edited", "edited_fp")
    rows = rows.withColumns({"own": hashes("fp"), "edit": hashes("edited_fp"), "following": hashes("next_fp")})
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), digest("fp").alias("fingerprint"),
        digest("edited_fp").alias("edited_fingerprint"), likeness("own", "edit").alias("near_edited"), likeness("own", "following").alias("near_next"),
    )
