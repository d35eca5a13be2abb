"""Toxicity: linear classifier over character n-grams scaled by naive Bayes
log-count ratios.

Features are the byte n-grams (``SIZES``) of lower-cased words with their edges,
hashed to ``2**BITS`` numbers; a document counts in how many of its distinct
words a feature occurs. Document frequencies per class give the log-count ratio r
of each feature; all features whose class frequencies differ by ``LEAST_Z``
standard errors enter a logistic
regression on count * r. A text's score is the regression's probability.

The fit uses at most ``sample_rows`` labelled rows (the smallest hashes of doc_id):
a documented bound. Scoring reads every word of every text.

Edge cases: NULL and empty texts score the intercept's probability; labels that
contradict each other count as toxic; without labels of both classes every
score is the share of toxic labels (0 without labels); repeated rows score alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from urbanlens.llm.chunks import gather
from urbanlens.llm.common import materialize, mix64, read, remainder, text_blocks
from urbanlens.llm.words import Words, powers

SIZES = (3, 4, 5)
BITS = 20
LEAST_Z = 4.0
SAMPLE_ROWS = 20_000
THRESHOLD = 0.3


class Vocabulary:
    """Distinct words of a block with the features of each, and the words of each row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = Words(data, offsets)
        _, first, code = np.unique(words.hash, return_index=True, return_inverse=True)
        self.n = len(first)
        # (row, distinct word), each once
        self.row, self.word = np.divmod(np.unique(words.row * max(self.n, 1) + code), max(self.n, 1))
        size = words.end[first] - words.start[first]
        inner, ends = gather(words.start[first], size, words.low, np.arange(self.n))
        # " word" after " word" ..., and a last blank
        text = np.full(len(inner) + self.n + 1, 0x20, np.uint8)
        start = ends[:-1] + np.arange(self.n)
        text[np.arange(len(inner)) + np.repeat(np.arange(self.n), size) + 1] = inner
        blanks = np.concatenate([[0], np.cumsum(text == 0x20)])
        up, down = powers(len(text) + 1)
        total = np.zeros(len(text) + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        owner = np.repeat(np.arange(self.n), size + 1)
        features, of = [], []
        for n in SIZES:
            m = len(text) - n + 1
            if m < 1 or not self.n:
                continue
            # blanks only at the ends, so the n-gram belongs to one word
            at = np.flatnonzero((blanks[n - 1 : n - 1 + m] - blanks[1 : 1 + m]) == 0)
            at = at[at < len(owner)]
            features.append((mix64((total[at + n] - total[at]) * down[at] + np.uint64(n)) & np.uint64((1 << BITS) - 1)).astype(np.int64))
            of.append(owner[at])
        self.feature = np.concatenate([*features, np.zeros(0, np.int64)])
        self.of = np.concatenate([*of, np.zeros(0, np.int64)])

    def word_sums(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.of, weights=weights[self.feature], minlength=self.n)

    def row_features(self, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, feature, count of distinct words), with a filter on features."""
        feature, of = self.feature, self.of
        if chosen is not None:
            keep = chosen[feature]
            feature, of = feature[keep], of[keep]
        order = np.argsort(of, kind="stable")
        feature, sizes = feature[order], np.bincount(of, minlength=self.n)
        run, ends = gather(np.cumsum(sizes) - sizes, sizes, feature, self.word)
        row = np.repeat(self.row, np.diff(ends))
        keys, count = np.unique((row << BITS) | run, return_counts=True)
        return keys >> BITS, keys & ((1 << BITS) - 1), count


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(toxic, text) of a bounded sample of the labelled documents."""
    marks = (
        labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )
    # sample_rows pairs at most: the proven bound of this broadcast
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(marks), "doc_id").select("toxic", "text")


def _frequencies(batches):
    """Documents of each class that have a feature, summed in the task."""
    count = np.zeros((2, 1 << BITS), np.int64)
    seen = np.zeros(2, np.int64)
    for batch in batches:
        toxic = (batch.column("toxic").to_numpy(zero_copy_only=False) > 0).astype(np.int64)
        for lo, hi, data, offsets in text_blocks(batch.column("text")):
            row, feature, _ = Vocabulary(data, offsets).row_features()
            label = toxic[lo:hi]
            seen += np.bincount(label, minlength=2)
            for c in (0, 1):
                count[c] += np.bincount(feature[label[row] == c], minlength=1 << BITS)
    some = np.flatnonzero(count.sum(0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(some, -1)), pa.array(np.append(count[0][some], seen[0])), pa.array(np.append(count[1][some], seen[1]))],
        ["feature", "clean", "toxic"],
    )


class Model:
    def __init__(self, weights: np.ndarray, intercept: float):
        self.weights, self.intercept = weights, intercept


def ratios(clean: np.ndarray, toxic: np.ndarray, n_clean: float, n_toxic: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-count ratio of each feature over add-one smoothed counts, and whether its
    frequencies in the classes differ by ``LEAST_Z`` standard errors."""
    mean = (toxic + clean) / (n_clean + n_toxic)
    z = (toxic / n_toxic - clean / n_clean) / np.sqrt(np.maximum(mean * (1 - mean), 1e-12) * (1 / n_clean + 1 / n_toxic))
    ratio = np.log((toxic + 1) / (toxic + 1).sum()) - np.log((clean + 1) / (clean + 1).sum())
    return ratio, np.abs(z) >= LEAST_Z


def fit(rows: DataFrame) -> Model:
    """Fit on (toxic, text)."""
    spark = rows.sparkSession
    rows = materialize(rows.repartition(2 * spark.sparkContext.defaultParallelism))
    # 2**BITS + 1 rows at most reach the driver
    found = (
        rows.mapInArrow(_frequencies, "feature bigint, clean bigint, toxic bigint")
        .groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).orderBy("feature").toPandas()
    )
    weights = np.zeros(1 << BITS)
    if not len(found) or not found.clean.iloc[0] or not found.toxic.iloc[0]:
        clean, toxic = (float(found[c].iloc[0]) if len(found) else 0.0 for c in ("clean", "toxic"))
        share = toxic / max(1.0, clean + toxic)
        return Model(weights, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    n0, n1 = float(found.clean.iloc[0]), float(found.toxic.iloc[0])
    feature, q, p = (found[c].to_numpy(np.int64)[1:] for c in ("feature", "clean", "toxic"))
    ratio, telling = ratios(q, p, n0, n1)
    chosen, r = feature[telling], ratio[telling]
    place = np.full(1 << BITS, -1, np.int64)
    place[chosen] = np.arange(len(chosen))
    shared = spark.sparkContext.broadcast((place, r))  # bounded by BITS

    def vectors(batches):
        place, r = shared.value
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False) > 0
            for lo, hi, data, offsets in text_blocks(batch.column("text")):
                row, feature, count = Vocabulary(data, offsets).row_features(place >= 0)
                at, value = place[feature], count * r[place[feature]]
                order = np.lexsort((at, row))
                row, at, value = row[order], at[order], value[order]
                ends = np.searchsorted(row, np.arange(hi - lo + 1))
                lists = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(x)) for x in (at.astype(np.int32), value)]
                yield pa.RecordBatch.from_arrays([pa.array(toxic[lo:hi].astype(np.float64)), *lists], ["label", "at", "value"])

    if not len(chosen):
        return Model(weights, float(np.log(n1 / n0)))
    width = len(chosen)
    vector = F.udf(lambda at, value: Vectors.sparse(width, at, value), VectorUDT())
    table = materialize(rows.mapInArrow(vectors, "label double, at array<int>, value array<double>"))
    line = LogisticRegression(regParam=0.002, standardization=False, maxIter=60).fit(table.select("label", vector("at", "value").alias("features")))
    weights[chosen] = line.coefficients.toArray() * r
    return Model(weights, float(line.intercept))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Add the probability that ``text`` is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS weights

    @arrow_udf(T.DoubleType())
    def judge(texts: pa.Array) -> pa.Array:
        m, out = shared.value, []
        for _, _, data, offsets in text_blocks(texts):
            v = Vocabulary(data, offsets)
            line = m.intercept + np.bincount(v.row, weights=v.word_sums(m.weights)[v.word], minlength=len(offsets) - 1)
            out.append(1 / (1 + np.exp(-np.clip(line, -500, 500))))
        return pa.array(np.concatenate([*out, np.zeros(0)]))

    return docs.withColumn(name, judge(F.coalesce(F.col("text"), F.lit(""))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = fit(training_rows(docs, labels.where(remainder(F.col("doc_id"), 4) != 2)))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
