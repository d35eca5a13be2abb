"""Row filters and imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# (low, low inclusive, high, high inclusive); ``None`` leaves that side open.
Bound = tuple[float | None, bool, float | None, bool]

# Trip validity rules of the cleaning job.
TRIP_BOUNDS: dict[str, Bound] = {
    "fare_amount": (0, False, 800, True),
    "trip_distance": (0, False, 100, True),
    "passenger_count": (0, False, None, False),
}
# Feature guardrails (minutes, miles per minute, miles).
GUARDRAIL_BOUNDS: dict[str, Bound] = {
    "trip_duration": (1.0, True, 180.0, True),
    "average_velocity": (0.033, True, 1.33, True),
    "trip_distance": (0.0, False, None, False),
}
# Constant imputation of the vendor-missing trip columns.
TRIP_IMPUTATION: dict[str, object] = {
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "congestion_surcharge": 0.0,
    "Airport_fee": 0.0,
}


def bounds_predicate(bounds: Mapping[str, Bound]) -> Column:
    """One conjunctive predicate; NULL values fail every bounded column."""
    pred = F.lit(True)
    for name, (lo, lo_inc, hi, hi_inc) in bounds.items():
        c = F.col(name)
        pred = pred & c.isNotNull()
        if lo is not None:
            pred = pred & ((c >= lo) if lo_inc else (c > lo))
        if hi is not None:
            pred = pred & ((c <= hi) if hi_inc else (c < hi))
    return pred


def filter_valid(df: DataFrame, bounds: Mapping[str, Bound] = TRIP_BOUNDS) -> DataFrame:
    """Keep rows inside every bound (pushed to the Parquet scan where possible)."""
    return df.filter(bounds_predicate(bounds))


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(cols))


def impute_constants(df: DataFrame, values: Mapping[str, object] = TRIP_IMPUTATION) -> DataFrame:
    """Replace NULLs per column with a constant (a missing column raises)."""
    missing = [c for c in values if c.lower() not in {x.lower() for x in df.columns}]
    if missing:
        raise ValueError(f"cannot impute missing columns: {missing}")
    return df.fillna(dict(values))


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Project ``cols`` and keep rows where none of them is NULL."""
    return df.select(*cols).dropna(how="any")


def exclude_values(
    df: DataFrame,
    col: str,
    values: Sequence[object] = (),
    min_rows: int | None = None,
    count_col: str = "trip_count",
) -> DataFrame:
    """Drop named categories and (on a report table) categories below ``min_rows``.

    NULL categories are kept, as an inequality filter in pandas would keep them.
    """
    out = df
    if values:
        out = out.filter(F.col(col).isNull() | ~F.col(col).isin(list(values)))
    if min_rows is not None:
        out = out.filter(F.col(count_col) >= min_rows)
    return out
