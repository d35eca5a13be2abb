"""The quality report from one scan per input (P6: A16, D1–D3, D10–D15).

``inspect`` makes one aggregate over a table: for every cell (a combination of a few
low-cardinality keys) the rows, the NULLs of every column, the rows that break each rule and
mergeable moments of the described columns. All tables of the report follow from the
cells, which are written once: counts and moments add up, frequencies are the cells'
rows by a key, distinct keys and coverage come from the cells' keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from urbanlens.operators import profile
from urbanlens.session import cut_lineage


@dataclass(frozen=True)
class Inspection:
    """Cells of a table and what its reports need to know of it."""

    cells: DataFrame
    schema: StructType
    rules: tuple[str, ...]
    described: tuple[str, ...]

    def table_report(self) -> DataFrame:
        """``(column_name, data_type, ordinal_position, row_count)``."""
        meta = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), F.lit(i + 1).alias("ordinal_position")) for i, f in enumerate(self.schema.fields)])
        total = self.cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"))
        return total.select(F.explode(meta).alias("m"), "row_count").select("m.*", "row_count")

    def nulls(self, columns: Sequence[str] | None = None) -> DataFrame:
        """``(column_name, null_count)``."""
        columns = list(columns) if columns is not None else self.schema.fieldNames()
        sums = self.cells.agg(*[F.coalesce(F.sum(f"nulls__{c}"), F.lit(0)).alias(c) for c in columns])
        return sums.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("null_count")) for c in columns])).alias("r")).select("r.*")

    def broken_rules(self) -> DataFrame:
        """One row: the number of rows that match each rule."""
        return self.cells.agg(*[F.coalesce(F.sum(f"rule__{r}"), F.lit(0)).alias(r) for r in self.rules])

    def describe(self, columns: Sequence[str] | None = None, digits: int | None = None) -> DataFrame:
        """Count, mean, sample standard deviation, minimum and maximum, a row each."""
        columns = list(columns) if columns is not None else list(self.described)
        found = {}
        for c in columns:
            n, mean = F.col(f"count__{c}"), F.col(f"mean__{c}")
            total, weighted = F.sum(n), F.sum(n * mean)
            # squares about the cells' means and of the means about that of all
            square = F.sum(f"square__{c}") + F.sum(n * mean * mean) - F.try_divide(weighted * weighted, total)
            found[c] = {
                "count": F.coalesce(total, F.lit(0)).cast("double"), "mean": F.try_divide(weighted, total),
                "stddev": F.when(total > 1, F.sqrt(F.greatest(square, F.lit(0.0)) / (total - 1))),
                "min": F.min(f"low__{c}"), "max": F.max(f"high__{c}"),
            }
        stats = ("count", "mean", "stddev", "min", "max")
        show = lambda x: F.round(x, digits) if digits is not None else x
        wide = self.cells.agg(*[show(found[c][s]).alias(f"{s}__{c}") for s in stats for c in columns])
        rows = F.array(*[F.struct(F.lit(s).alias("statistic"), *[F.col(f"`{s}__{c}`").alias(c) for c in columns]) for s in stats])
        return wide.select(F.explode(rows).alias("r")).select("r.*")

    def frequency(self, key: str, alias: str = "count", rule: str | None = None, by_count: bool = True) -> DataFrame:
        """Rows by a key of the cells, or those of them that match a rule."""
        rows = self.cells.groupBy(key).agg(F.sum("n" if rule is None else f"rule__{rule}").alias(alias))
        rows = rows.where(F.col(alias) > 0)
        return rows.orderBy(F.desc(alias), F.asc_nulls_first(key)) if by_count else rows.orderBy(F.asc_nulls_first(key))

    def distinct(self, key: str, alias: str = "n_distinct") -> DataFrame:
        return self.cells.agg(F.count_distinct(key).alias(alias))

    def key_counts(self, key: str) -> DataFrame:
        return self.cells.groupBy(key).agg(F.sum("n").alias("n_rows"))

    def coverage(self, key: str) -> DataFrame:
        return profile.coverage_of(self.key_counts(key).withColumnRenamed("n_rows", "n"))


def cells(df: DataFrame, keys: Sequence[str] = (), rules: Mapping[str, Column] | None = None, described: Mapping[str, Column] | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """One aggregate over ``df`` by ``keys``."""
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls__{c}") for c in (columns if columns is not None else df.columns)]
    aggs += [F.count_if(p).alias(f"rule__{name}") for name, p in (rules or {}).items()]
    for name, c in (described or {}).items():
        x = c.cast("double")
        aggs += [F.count(x).alias(f"count__{name}"), F.avg(x).alias(f"mean__{name}"), (F.var_pop(x) * F.count(x)).alias(f"square__{name}"), F.min(x).alias(f"low__{name}"), F.max(x).alias(f"high__{name}")]
    return df.groupBy(*keys).agg(*aggs)


def inspect(df: DataFrame, keys: Sequence[str] = (), rules: Mapping[str, Column] | None = None, described: Mapping[str, Column] | Sequence[str] = ()) -> Inspection:
    """Scan ``df`` once and write its cells; as many as combinations of ``keys`` occur."""
    columns = dict(described) if isinstance(described, Mapping) else {c: F.col(c) for c in described}
    return Inspection(cut_lineage(cells(df, keys, rules, columns)), df.schema, tuple(rules or ()), tuple(columns))
