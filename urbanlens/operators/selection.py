"""Exact quantiles by distributed selection.

``percentile_disc`` keeps a map of all distinct values of a group. Selection keeps
a window of values that holds the wanted rank and narrows it: a quantile sketch of the window
gives ``BINS`` splitters, an exact histogram counts the rows equal to and between them, and the
window becomes the bin with the rank. A round shrinks a window about ``BINS``-fold, or ends on a
value that many rows share, whatever the distribution. Windows of at most ``few`` rows are
sorted. Memory is the sketch and ``2 * BINS + 1`` counts a group; shuffles carry sketches
and counts, not rows (but for the last windows).
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.session import cut_lineage, stored

BINS = 64
FEW = 10_000
BROADCAST = 16_384  # windows sent to all tasks: rows of few groups would else meet in as few tasks


def _copies(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).alias(f"__key_{k}") for k in keys]


def _equal(keys: Sequence[str]) -> Column:
    """Keys equal their copies on the other side; NULL keys are a group like any other."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    return cond


def _windowed(rows: DataFrame, state: DataFrame, n: int, keys: Sequence[str], *more: str) -> DataFrame:
    """Rows inside their group's ``n`` windows, a copy for each window."""
    s = state.select(*_copies(keys), "fraction", "__low", "__high", *more)
    s = F.broadcast(s) if n <= BROADCAST else s
    return rows.join(s, _equal(keys) & F.col("__v").between(F.col("__low"), F.col("__high")))


def select_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, fractions: Sequence[float] = (0.5,), few: int = FEW, bins: int = BINS, rounds: list[int] | None = None
) -> DataFrame:
    """``(*keys, fraction, value)``: the smallest value whose rank reaches ``fraction`` of the group's non-NULL
    values, as ``percentile_disc`` gives; NULL for a group without any. ``rounds``, if given, gets the
    number of windows narrowed by each round."""
    if not all(0 < q <= 1 for q in fractions):
        raise ValueError("fractions lie above 0 and reach 1 at most")
    keys = list(keys)
    rows = stored(df.select(*keys, F.col(value).alias("__v")))  # what is behind them runs once, each round reads two columns
    per_group = rows.groupBy(*keys).agg(F.count("__v").alias("__rows"), F.min("__v").alias("__low"), F.max("__v").alias("__high"))
    each = F.explode(F.array(*[F.lit(float(q)) for q in fractions])).alias("fraction")
    rank = F.greatest(F.lit(1), F.ceil(F.col("fraction") * F.col("__rows")).cast("long")).alias("__rank")
    state = cut_lineage(per_group.select("*", each).select(*keys, "fraction", rank, "__rows", "__low", "__high"))
    done = [state.where("__rows = 0 or __low = __high")]
    small = []
    rows = rows.where("__v is not null")
    while True:
        left = state.where("__rows > 0 and __low <> __high")
        small.append(left.where(F.col("__rows") <= few))
        wide = cut_lineage(left.where(F.col("__rows") > few))
        n = wide.count()
        if not n:
            break
        if rounds is not None:
            rounds.append(n)
        state = _narrow(rows, wide, n, keys, bins)
        done.append(state.where("__low = __high"))
    ready = functools.reduce(DataFrame.unionByName, done).select(*keys, "fraction", F.col("__low").alias("value"))
    last = functools.reduce(DataFrame.unionByName, small)
    held = _windowed(rows, last, last.count(), keys, "__rank").groupBy(*keys, "fraction")
    return ready.unionByName(held.agg(F.element_at(F.array_sort(F.collect_list("__v")), F.first("__rank").cast("int")).alias("value")))


def _place(rows: DataFrame, bins: int) -> DataFrame:
    """Rows with ``bin``: twice the number of splitters below the value, and one more if the next one equals it. The
    number is found by halving, a column a step."""
    rows = rows.withColumn("__below", F.lit(0))
    for i in reversed(range((bins - 1).bit_length())):
        step = 1 << i
        rows = rows.withColumn("__below", F.col("__below") + F.when(F.get("__splits", F.col("__below") + (step - 1)) < F.col("__v"), step).otherwise(0))
    equal = F.coalesce(F.get("__splits", F.col("__below")) == F.col("__v"), F.lit(False))
    return rows.withColumn("bin", 2 * F.col("__below") + equal.cast("int"))


def _narrow(rows: DataFrame, wide: DataFrame, n: int, keys: Sequence[str], bins: int) -> DataFrame:
    """Windows after one round: the bin (a splitter, or what lies between two) that holds the rank."""
    at = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    splits = _windowed(rows, wide, n, keys).groupBy(*keys, "fraction").agg(F.array_distinct(F.percentile_approx("__v", at, F.lit(10 * bins))).alias("__splits"))
    named = splits.select(*_copies(keys), F.col("fraction").alias("__fraction"), "__splits")
    split = cut_lineage(wide.join(named, _equal(keys) & (F.col("fraction") == F.col("__fraction"))).select(*wide.columns, "__splits"))
    counts = (
        _place(_windowed(rows, split, n, keys, "__splits"), bins).groupBy(*keys, "fraction", "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.min("__v").alias("low"), F.max("__v").alias("high"))
        .groupBy(*keys, "fraction").agg(F.sort_array(F.collect_list(F.struct("bin", "n", "low", "high"))).alias("__bins"))  # 2 * bins at most
    )
    ranks = wide.select(*_copies(keys), F.col("fraction").alias("__fraction"), "__rank")
    kind = dict(rows.dtypes)["__v"]
    hit = F.expr(
        f"aggregate(__bins, named_struct('n', 0L, 'at', 0L, 'hit', cast(null as struct<bin:int,n:bigint,low:{kind},high:{kind}>)), "
        "(s, b) -> named_struct('n', s.n + b.n, 'at', if(s.n < __rank, s.n, s.at), 'hit', if(s.n < __rank, b, s.hit)))"
    )
    found = counts.join(ranks, _equal(keys) & (F.col("fraction") == F.col("__fraction"))).withColumn("__w", hit)
    return cut_lineage(found.select(
        *keys, "fraction", (F.col("__rank") - F.col("__w.at")).alias("__rank"), F.col("__w.hit.n").alias("__rows"), F.col("__w.hit.low").alias("__low"), F.col("__w.hit.high").alias("__high")
    ))
