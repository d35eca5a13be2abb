"""Data-quality and profiling aggregates.

Each report is ONE aggregate over the input (a single scan), instead of one job
per rule or per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _stack(df: DataFrame, key: str, value: str) -> DataFrame:
    """Wide one-row frame -> long ``(key, value)`` rows."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return df.selectExpr(f"stack({len(df.columns)}, {pairs}) as ({key}, {value})")


def table_report(df: DataFrame) -> DataFrame:
    """``(column_name, data_type, ordinal_position, row_count)`` per column.

    Column metadata comes from the schema; the row count is one aggregate, and
    the metadata rows are exploded from that single row (no join).
    """
    meta = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(i + 1).alias("ordinal_position"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return (
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.explode(meta).alias("m"), "row_count")
        .select("m.column_name", "m.data_type", "m.ordinal_position", "row_count")
    )


def sample_rows(df: DataFrame, by: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``by``: the same rows on every run."""
    return df.orderBy(*by).limit(n)


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: NULL count per column (all columns by default)."""
    cols = list(cols) if cols is not None else df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def null_counts_long(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return _stack(null_counts(df, cols), "column_name", "null_count")


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row: number of rows matching each named predicate."""
    return df.agg(*[F.count_if(pred).alias(name) for name, pred in rules.items()])


def rows_removed(df: DataFrame, keep: Column) -> DataFrame:
    """Rows before / after a filter and the difference, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(keep).alias("rows_after"),
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


_STAT_FUNCS = {
    "count": lambda c: F.count(c).cast("double"),
    "mean": F.avg,
    "stddev": F.stddev_samp,
    "min": lambda c: F.min(c).cast("double"),
    "max": lambda c: F.max(c).cast("double"),
}


def describe(
    df: DataFrame,
    cols: Sequence[str],
    stats: Sequence[str] = ("count", "mean", "stddev", "min", "max"),
    digits: int | None = None,
    accuracy: int = 10000,
) -> DataFrame:
    """Long-form statistics: one row per statistic, one column per input column.

    Percentile statistics (``"25%"``) use the bounded-memory quantile sketch,
    as ``DataFrame.summary`` does.
    """
    aggs = []
    for st in stats:
        for c in cols:
            if st.endswith("%"):
                expr = F.percentile_approx(F.col(c), float(st[:-1]) / 100.0, accuracy).cast("double")
            else:
                expr = _STAT_FUNCS[st](F.col(c))
            if digits is not None:
                expr = F.round(expr, digits)
            aggs.append(expr.alias(f"{st}__{c}"))
    wide = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(F.lit(st).alias("statistic"), *[F.col(f"`{st}__{c}`").alias(c) for c in cols])
            for st in stats
        ]
    )
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def count_distinct(df: DataFrame, cols: Sequence[str], alias: str = "n_distinct") -> DataFrame:
    """Exact distinct count (two-phase distinct aggregation, partial per task)."""
    return df.agg(F.count_distinct(*[F.col(c) for c in cols]).alias(alias))


def frequency(df: DataFrame, col: str, order: str = "count", alias: str = "count") -> DataFrame:
    """Value counts; ordered by count (desc, then key) or by key."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias(alias))
    if order == "count":
        return out.orderBy(F.desc(alias), F.asc_nulls_first(col))
    return out.orderBy(F.asc_nulls_first(col))


def columns_matching(
    df: DataFrame, names: Sequence[str] | None = None, contains: Sequence[str] | None = None
) -> list[str]:
    """Existing columns from a wish list or by substring, case-insensitively."""
    lower = {c.lower(): c for c in df.columns}
    out: list[str] = []
    for n in names or ():
        if n.lower() in lower and lower[n.lower()] not in out:
            out.append(lower[n.lower()])
    for part in contains or ():
        for c in df.columns:
            if part.lower() in c.lower() and c not in out:
                out.append(c)
    return out
