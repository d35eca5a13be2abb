"""Language identification with language-bitmask n-gram filters.

Every language keeps the byte 4-grams that make up at least ``min_share`` of its
training text, so a language holds at most 1/min_share n-grams. All languages
share one bit-sliced Bloom filter: a table of ``2**slot_bits`` slots whose entry
is a bit mask over languages. The AND of an n-gram's ``HASHES`` slots is the set of
languages that contain it. A text's hits per language (popcounts over its
n-grams) are corrected for the filter's false positives and the largest share
wins.

Edge cases: NULL or letterless text gives ``und`` with score 0; a tie goes to the
alphabetically first language; no hit at all gives the language with the most training text, with
score 0; no training row at all gives ``und`` everywhere. Extra
columns pass through; repeated rows are judged alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from urbanlens.llm.common import materialize, mix64, remainder, sums_by_row, text_blocks

HASHES = 3
MIN_SHARE = 5e-5
SLOT_BITS = 18
MAX_LANGUAGES = 1024

# Byte classes: A-Z folded, other ASCII non-letters become one blank, bytes of
# non-ASCII characters stay.
_FOLD = np.full(256, 0x20, np.uint32)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def ngram_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the byte 4-grams that start at each byte, and which are valid
    (inside one row, no two blanks in succession)."""
    b = _FOLD[data]
    n = len(b)
    if n < 4:
        return np.zeros(0, np.uint32), np.zeros(0, bool)
    code = b[:-3] | (b[1:-2] << 8) | (b[2:-1] << 16) | (b[3:] << 24)
    blank = b == 0x20
    double = blank[:-1] & blank[1:]
    ok = ~(double[:-2] | double[1:-1] | double[2:])
    for back in (1, 2, 3):  # windows that run over the end of a row
        at = offsets[1:-1] - back
        ok[at[(at >= 0) & (at < n - 3)]] = False
    return code, ok


def _count(batches):
    """(lang, n-gram, count) of one partition, counted exactly in the task."""
    held: dict[str, list[np.ndarray]] = {}

    def fold(parts):
        keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return keys, np.bincount(at, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)

    for batch in batches:
        order = batch.column(0).dictionary_encode()
        names, langs = order.dictionary.to_pylist(), order.indices.to_numpy(zero_copy_only=False)
        for lo, hi, data, offsets in text_blocks(batch.column(1)):
            code, ok = ngram_codes(data, offsets)
            if not len(code):
                continue
            row = np.repeat(langs[lo:hi].astype(np.uint64), np.diff(offsets))[: len(code)][ok]
            keys, counts = np.unique(code[ok].astype(np.uint64) | (row << np.uint64(32)), return_counts=True)
            which = (keys >> np.uint64(32)).astype(np.int64)
            for at in np.unique(which):
                mine = which == at
                parts = held.setdefault(names[at], [])
                parts.append(((keys[mine] & np.uint64(0xFFFFFFFF)).astype(np.int64), counts[mine]))
                if len(parts) >= 16:
                    held[names[at]] = [fold(parts)]
    for name, parts in held.items():
        keys, counts = fold(parts)
        keys, counts = np.append(keys, -1), np.append(counts, counts.sum())  # -1: the language's total
        for at in range(0, len(keys), 100_000):
            k = keys[at : at + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]).take(pa.array(np.zeros(len(k), np.int32))), pa.array(k), pa.array(counts[at : at + 100_000])],
                ["lang", "gram", "n"],
            )


class Model:
    """Slot table (languages bit by bit, 64 to a word) and fill of each language."""

    def __init__(self, langs: list[str], table: np.ndarray, commonest: int = 0):
        self.langs, self.table, self.commonest = langs, table, commonest
        fill = [((table[at // 64] >> np.uint64(at % 64)) & np.uint64(1)).mean() for at in range(len(langs))]
        self.false_rate = np.minimum(np.array(fill) ** HASHES, 0.999)


def slots_of(grams, bits: int):
    """Slot numbers of n-gram codes, one array per hash."""
    h = mix64(np.asarray(grams).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return [((h >> np.uint64(20 * i)) & np.uint64((1 << bits) - 1)).astype(np.int64) for i in range(HASHES)]


def fit(train: DataFrame, min_share: float = MIN_SHARE, slot_bits: int = SLOT_BITS) -> Model:
    """Learn from columns ``text`` and ``lang`` (rows with either NULL are left out)."""
    if slot_bits > 20:
        raise ValueError("slot_bits is 20 at most")
    rows = train.where("lang is not null and text is not null").select("lang", "text")
    counts = materialize(
        rows.mapInArrow(_count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    totals = {r.lang: r.n for r in counts.where("gram = -1").limit(MAX_LANGUAGES + 1).collect()}
    if len(totals) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    langs = sorted(totals)
    words = max(1, -(-len(langs) // 64))
    table = np.zeros((words, 1 << slot_bits), np.uint64)
    if langs:
        order = counts.sparkSession.createDataFrame([(x, i, float(totals[x])) for i, x in enumerate(langs)], "lang string, at int, total double")
        kept = counts.where("gram >= 0").join(F.broadcast(order), "lang").where(F.col("n") >= F.col("total") * min_share)

        def place(batches):
            for batch in batches:
                at = batch.column("at").to_numpy(zero_copy_only=False).astype(np.int64)
                mask = (np.uint64(1) << (at % 64).astype(np.uint64)).view(np.int64)
                for slot in slots_of(batch.column("gram").to_numpy(), slot_bits):
                    yield pa.RecordBatch.from_arrays([pa.array(at // 64), pa.array(slot), pa.array(mask)], ["word", "slot", "mask"])

        # at most words * 2**slot_bits rows reach the driver, whatever the corpus
        sliced = kept.select("at", "gram").mapInArrow(place, "word bigint, slot bigint, mask bigint")
        out = sliced.groupBy("word", "slot").agg(F.bit_or("mask").alias("mask")).toPandas()
        table[out["word"].to_numpy(np.int64), out["slot"].to_numpy(np.int64)] = out["mask"].to_numpy(np.int64).view(np.uint64)
    return Model(langs, table, max(range(len(langs)), key=lambda i: totals[langs[i]], default=0))


# For each byte value, its bits: turns histograms of mask bytes into popcounts.
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)


def hits(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row: n-grams read, and for each language those its filter contains."""
    rows, langs = len(offsets) - 1, len(model.langs)
    code, ok = ngram_codes(data, offsets)
    found = np.zeros((rows, langs))
    valid = np.zeros(len(data), np.int64)
    valid[: len(ok)] = ok
    read = sums_by_row(valid, offsets)
    if ok.any():
        row = np.repeat(np.arange(rows), np.diff(offsets))[: len(code)][ok]
        slots = slots_of(code[ok], model.table.shape[1].bit_length() - 1)
        for word in range(model.table.shape[0]):
            mask = model.table[word][slots[0]]
            for s in slots[1:]:
                mask &= model.table[word][s]
            for byte in range(8):
                first = word * 64 + byte * 8
                if first >= langs:
                    break
                value = ((mask >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.int64)
                counts = np.bincount(row * 256 + value, minlength=rows * 256).reshape(rows, 256)
                found[:, first : first + 8] = (counts @ _BITS)[:, : langs - first]
    return read, found


def predict(docs: DataFrame, model: Model, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add the predicted language and its share of the corrected hits to ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by slot_bits and MAX_LANGUAGES

    @arrow_udf("struct<lang:string,score:double>")
    def judge(texts: pa.Array) -> pa.Array:
        m = shared.value
        names, best, scores = np.array([*m.langs, "und"], object), [], []
        for _, _, data, offsets in text_blocks(texts):
            if not m.langs:
                best.append(np.full(len(offsets) - 1, 0)), scores.append(np.zeros(len(offsets) - 1))
                continue
            read, found = hits(m, data, offsets)
            sure = np.maximum(0, (found - read[:, None] * m.false_rate) / (1 - m.false_rate))
            total = sure.sum(1)
            best.append(np.where(total > 0, sure.argmax(1), m.commonest))
            scores.append(np.where(total > 0, sure.max(1) / np.maximum(total, 1e-12), 0.0))
        best, scores = np.concatenate([*best, np.zeros(0, np.int64)]), np.concatenate([*scores, np.zeros(0)])
        return pa.StructArray.from_arrays([pa.array(names[best], pa.string()), pa.array(scores)], ["lang", "score"])

    text = F.col("text")
    letters = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    return (
        docs.withColumn("__judged", judge(F.coalesce(text, F.lit(""))))
        .withColumn(pred, F.when(letters, F.col("__judged.lang")).otherwise(F.lit("und")))
        .withColumn(score, F.when(letters, F.col("__judged.score")).otherwise(F.lit(0.0)))
        .drop("__judged")
    )


def training_rows(docs: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """Rows outside the held-out fold (a NULL doc_id is never trained on)."""
    return docs.where(remainder(F.col("doc_id"), folds) != held)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from urbanlens.llm.common import read

    docs = read(spark, sf_dir, "documents")
    model = fit(training_rows(docs))
    judged = predict(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def reject_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents in which no language can be told (``und``) go."""
    model = fit(training_rows(docs))
    return predict(docs, model, "__lang", "__score").where("__lang <> 'und'").select(*docs.columns)
