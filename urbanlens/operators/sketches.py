"""Mergeable column sketches (D1–D3, D10–D14): one scan, kept per part, merged later.

``sketch`` makes one row per part of a table (a month, a file, a load) in a single
aggregate: exact counts and moments, a HyperLogLog sketch of distinct values, a KLL
sketch of quantiles and a frequent-items sketch. Rows of parts are a few dozen
kilobytes, whatever the part's size; they can be stored and ``merge``d with those of new parts
without reading the old data. ``report`` turns them into figures with their error bounds.

Bounds: distinct counts within ``DISTINCT_ERROR`` (about three standard errors of
2^``LOG_K`` registers), ranks of quantiles within ``RANK_ERROR``, counts of frequent values within
``FREQUENT_ERROR`` of the rows; the last are exact while a column has fewer than three quarters of ``TRACKED`` values.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_K = 14
KLL_K = 800
DISTINCT_ERROR = 0.025
RANK_ERROR = 0.01
TRACKED = 1024
FREQUENT_ERROR = 3.5 / TRACKED
FREQUENT = 10
QUANTILES = (0.25, 0.5, 0.75)


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def sketch(df: DataFrame, columns: Sequence[str], numeric: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """One row per part ``by``: ``n_rows`` and for each column ``c`` the fields ``c__nulls, c__distinct, c__frequent`` and, if it is
    numeric, ``c__low, c__high, c__n, c__mean, c__square`` (sum of squared deviations) ``, c__kll``."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        # text and numbers alike: the sketch takes the text of a value
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"), F.hll_sketch_agg(F.col(c).cast("string"), LOG_K).alias(f"{c}__distinct")]
        aggs.append(F.expr(f"approx_top_k_accumulate(cast(`{c}` as string), {TRACKED})").alias(f"{c}__frequent"))
        if c in numeric:
            x = F.col(c).cast("double")
            aggs += [
                F.min(x).alias(f"{c}__low"), F.max(x).alias(f"{c}__high"), F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"),
                (F.var_pop(x) * F.count(x)).alias(f"{c}__square"), F.kll_sketch_agg_double(x, KLL_K).alias(f"{c}__kll"),
            ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def merge(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of parts as one row, or one per ``by``."""
    names = [c for c in parts.columns if "__" in c]
    columns = list(dict.fromkeys(c.rsplit("__", 1)[0] for c in names))
    aggs = [F.sum("n_rows").alias("n_rows")]
    for c in columns:
        aggs += [F.sum(_q(f"{c}__nulls")).alias(f"{c}__nulls"), F.hll_union_agg(_q(f"{c}__distinct")).alias(f"{c}__distinct")]
        aggs.append(F.expr(f"approx_top_k_combine(`{c}__frequent`, {TRACKED})").alias(f"{c}__frequent"))
        if f"{c}__kll" in names:
            n, mean = _q(f"{c}__n"), _q(f"{c}__mean")
            total, weighted = F.sum(n), F.sum(n * mean)
            # deviations from the parts' means, and of these from the mean of all
            square = F.sum(_q(f"{c}__square")) + F.sum(n * mean * mean) - F.try_divide(weighted * weighted, total)
            aggs += [
                F.min(_q(f"{c}__low")).alias(f"{c}__low"), F.max(_q(f"{c}__high")).alias(f"{c}__high"), total.alias(f"{c}__n"),
                F.try_divide(weighted, total).alias(f"{c}__mean"), F.greatest(square, F.lit(0.0)).alias(f"{c}__square"), F.kll_merge_agg_double(_q(f"{c}__kll")).alias(f"{c}__kll"),
            ]
    return parts.groupBy(*by).agg(*aggs) if by else parts.agg(*aggs)


def report(merged: DataFrame, quantiles: Sequence[float] = QUANTILES, frequent: int = FREQUENT) -> DataFrame:
    """A row per column: ``column_name, n_rows, nulls, least, most, mean, stddev, distinct_estimate, quantiles``
    (array of estimates for ``quantiles``) and ``frequent`` (array of the values found most often, as text, and their
    counts); the numeric figures are NULL for other columns."""
    names = merged.columns
    columns = list(dict.fromkeys(c.rsplit("__", 1)[0] for c in names if "__" in c))
    rows = []
    for c in columns:
        number = f"{c}__kll" in names
        none = F.lit(None).cast("double")
        fields = [F.lit(c).alias("column_name"), F.col("n_rows").alias("n_rows"), _q(f"{c}__nulls").alias("nulls")]
        fields += [(_q(f"{c}__{k}") if number else none).alias(n) for k, n in (("low", "least"), ("high", "most"), ("mean", "mean"))]
        deviation = F.when(_q(f"{c}__n") > 1, F.sqrt(_q(f"{c}__square") / (_q(f"{c}__n") - 1))) if number else none
        some = F.array(*[F.lit(float(x)) for x in quantiles])
        estimates = F.when(_q(f"{c}__n") > 0, F.kll_sketch_get_quantile_double(_q(f"{c}__kll"), some)) if number else F.lit(None).cast("array<double>")
        fields += [deviation.alias("stddev"), F.hll_sketch_estimate(_q(f"{c}__distinct")).alias("distinct_estimate"), estimates.alias("quantiles")]
        fields.append(F.expr(f"slice(filter(approx_top_k_estimate(`{c}__frequent`, {frequent + 1}), x -> x.item is not null), 1, {frequent})").alias("frequent"))
        rows.append(F.struct(*fields))
    return merged.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def checked(df: DataFrame, estimates: DataFrame, numeric: Sequence[str] = (), quantiles: Sequence[float] = QUANTILES, digits: int = 6) -> DataFrame:
    """The report beside exact figures: ``n_distinct`` is exact, ``distinct_in_bounds`` and ``quantiles_in_bounds`` say
    whether the estimates keep to their bounds (the ranks of the estimated quantiles are counted). ``df`` is read once for each
    column and once for the ranks."""
    found = {r.column_name: r.quantiles for r in estimates.select("column_name", "quantiles").collect()}  # a row per column
    columns = list(found)
    aggs = []
    for c in columns:
        fields = [F.lit(c).alias("column_name")]
        if c in numeric and found[c]:
            x = F.col(c).cast("double")
            off = [
                # the estimate's ranks, from the first to the last of equal values, reach the wanted one within the bound
                (F.avg((x < at).cast("double")) <= q + RANK_ERROR) & (F.avg((x <= at).cast("double")) >= q - RANK_ERROR)
                for at, q in zip(found[c], quantiles, strict=True)
            ]
            good = off[0]
            for o in off[1:]:
                good = good & o
            fields.append(good.alias("quantiles_in_bounds"))
        else:
            fields.append(F.lit(None).cast("boolean").alias("quantiles_in_bounds"))
        aggs.append(F.struct(*fields).alias(f"r_{c}"))
    exact = df.agg(*aggs).select(F.explode(F.array(*[_q(f"r_{c}") for c in columns])).alias("r")).select("r.*")
    # distinct values column by column: together, every row would be copied with all columns for each of them
    distinct = [df.select(c).where(F.col(c).isNotNull()).distinct().agg(F.count(F.lit(1)).alias("n_distinct")).select(F.lit(c).alias("column_name"), "n_distinct") for c in columns]
    joined = estimates.join(exact, "column_name").join(functools.reduce(DataFrame.unionByName, distinct), "column_name")
    near = F.abs(F.col("distinct_estimate") - F.col("n_distinct")) <= F.ceil(F.col("n_distinct") * DISTINCT_ERROR)
    return joined.select(
        "column_name", "n_rows", "nulls", "least", "most", F.round("mean", digits).alias("mean"), F.round("stddev", digits).alias("stddev"),
        "n_distinct", near.alias("distinct_in_bounds"), "quantiles_in_bounds",
    )
