"""Sensor profiles.

Medians use ``percentile_disc`` (exact lower median). Its aggregation buffer is a
map of *distinct values* to counts, merged partial -> final, so a hot group with a
third of all rows costs memory proportional to its distinct volumes, not its
rows. ``method="approx"`` uses the fixed-size quantile sketch instead, ``method="select"`` distributed
selection (exact, for groups of very many distinct values).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.operators.selection import select_quantiles


def median(value: str, method: str = "exact", accuracy: int = 10000) -> Column:
    if method == "exact":
        return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{value}`)")
    if method == "approx":
        return F.percentile_approx(F.col(value), 0.5, accuracy)
    raise ValueError(f"unknown median method {method!r}")


def median_profile(
    df: DataFrame,
    keys: Sequence[str] = ("SegmentID", "Boro", "street", "day_of_week", "HH"),
    value: str = "Vol_numeric",
    alias: str = "historical_median_volume",
    method: str = "exact",
) -> DataFrame:
    """One row per key group with the median of ``value`` (int). ``method="select"`` finds exact
    medians by selection, in memory that does not grow with the distinct values."""
    if method == "select":
        return select_quantiles(df, keys, value).select(*keys, F.col("value").cast("int").alias(alias))
    return df.groupBy(*keys).agg(median(value, method).cast("int").alias(alias))


def rollup_profile(
    profile: DataFrame,
    keys: Sequence[str] = ("Boro", "day_of_week", "HH"),
    value: str = "historical_median_volume",
    prefix: str = "boro_",
) -> DataFrame:
    """Second-level profile: rounded mean, max and rounded sample stddev.

    ``{prefix}volume_stddev`` is NULL for one-row groups.
    """
    return profile.groupBy(*keys).agg(
        F.round(F.avg(value)).alias(f"{prefix}avg_median_volume"),
        F.max(value).alias(f"{prefix}max_volume"),
        F.round(F.stddev_samp(value)).alias(f"{prefix}volume_stddev"),
    )


def coverage(df: DataFrame, key: str) -> DataFrame:
    """Rows per key, then the five-number summary of those counts (one row).

    The quartiles are exact; their buffers hold one entry per distinct count.
    """
    return coverage_of(df.groupBy(key).agg(F.count(F.lit(1)).alias("n")))


def coverage_of(per_key: DataFrame) -> DataFrame:
    """Summary of the counts ``n``, a row per key."""
    pct = {"min_rows": None, "p25_rows": 0.25, "p50_rows": 0.5, "p75_rows": 0.75, "max_rows": None}
    aggs = []
    for name, p in pct.items():
        if p is None:
            aggs.append((F.min("n") if name == "min_rows" else F.max("n")).alias(name))
        else:
            aggs.append(F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY n)").cast("bigint").alias(name))
    return per_key.agg(F.count(F.lit(1)).alias("n_keys"), *aggs)


def key_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
