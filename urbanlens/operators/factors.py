"""Latent factors of item texts by randomized SVD over a Gram matrix.

The weighted term matrix X (an item a row, hashed terms as columns) is only read once: tasks
add up their rows' outer products, and the sum X'X has ``dim``² cells whatever the number of items. A
randomized range finder on it (a seeded test matrix, power steps, QR) gives the leading right
singular vectors; an item's factors are its row times these. Signs are fixed by the largest
component of a vector, so results are the same on every run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_DIM = 4096  # the Gram matrix, 128 MB then, is held by the driver and every task


def _dense(batch: pa.RecordBatch, dim: int, column: str) -> np.ndarray:
    cells = batch.column(column)
    owner = np.repeat(np.arange(batch.num_rows), np.diff(cells.offsets.to_numpy()))
    flat = cells.flatten()
    out = np.zeros((batch.num_rows, dim))
    np.add.at(out, (owner, flat.field("at").to_numpy().astype(np.int64)), flat.field("w").to_numpy())
    return out


def gram(rows: DataFrame, dim: int, column: str = "cells") -> DataFrame:
    """``(at, products)``: row ``at`` of X'X as an array, for rows with anything. ``rows`` hold X sparsely,
    as an ``array<struct<at:int,w:double>>``."""
    if dim > MOST_DIM:
        raise ValueError(f"at most {MOST_DIM} columns")

    def add(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                x = _dense(batch.slice(lo, 256), dim, column)
                total += x.T @ x
        used = np.flatnonzero(total.any(axis=1))
        ends = pa.array(np.arange(len(used) + 1, dtype=np.int32) * dim)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.ListArray.from_arrays(ends, pa.array(total[used].reshape(-1)))], ["at", "products"])

    sums = rows.where(F.size(column) > 0).select(column).mapInArrow(add, "at int, products array<double>")
    return sums.groupBy("at").agg(Summarizer.sum(array_to_vector("products")).alias("s")).select("at", vector_to_array("s").alias("products"))


def leading(matrix: np.ndarray, rank: int, oversample: int = 8, power: int = 16, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Leading singular values of X and its right singular vectors (columns) from X'X."""
    dim = len(matrix)
    wide = min(dim, rank + oversample)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, wide)))[0]
    for _ in range(power):
        q = np.linalg.qr(matrix @ q)[0]
    values, vectors = np.linalg.eigh(q.T @ matrix @ q)
    order = np.argsort(-values)[:rank]
    right = q @ vectors[:, order]
    right *= np.where(right[np.abs(right).argmax(axis=0), np.arange(right.shape[1])] < 0, -1.0, 1.0)
    return np.sqrt(np.maximum(values[order], 0)), right


def latent_factors(rows: DataFrame, dim: int, rank: int, key: str = "item_id", column: str = "cells", seed: int = 42) -> DataFrame:
    """``(key, embedding array<double>)``: rows of X in the space of the ``rank`` leading right singular vectors."""
    if not 1 <= rank <= dim:
        raise ValueError("1 <= rank <= dim")
    matrix = np.zeros((dim, dim))
    for r in gram(rows, dim, column).collect():  # dim rows
        matrix[r["at"]] = r["products"]
    right = rows.sparkSession.sparkContext.broadcast(leading((matrix + matrix.T) / 2, rank, seed=seed)[1])

    def project(batches):
        for batch in batches:
            found = _dense(batch, dim, column) @ right.value
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * rank)
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.ListArray.from_arrays(ends, pa.array(found.reshape(-1)))], [key, "embedding"])

    whole = rows.select(key, F.coalesce(column, F.array().cast("array<struct<at:int,w:double>>")).alias(column))
    # the size of an array is guessed as that of one element: without the hint all vectors would be broadcast by the driver
    return whole.mapInArrow(project, f"{key} {dict(rows.dtypes)[key]}, embedding array<double>").hint("merge")
