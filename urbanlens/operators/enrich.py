"""Dimension lookups, profile joins and join audits.

Broadcast policy: no hints. The optimizer broadcasts a side whose measured size is below
its threshold (and AQE re-plans from run-time sizes); larger dimensions are joined by
sort-merge with skew splitting.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(dim: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (a left join on them would add rows)."""
    return dim.groupBy(*keys).count().filter(F.col("count") > 1)


def assert_unique(dim: DataFrame, keys: list[str]) -> None:
    """Fail when a dimension key is duplicated (one tiny action)."""
    dups = duplicate_keys(dim, keys).limit(1).collect()
    if dups:
        raise ValueError(f"dimension key {keys} is not unique, e.g. {dups[0].asDict()}")


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    rename: Mapping[str, str],
    how: str = "left",
) -> DataFrame:
    """Left equi-join of ``fact`` to a small dimension, taking renamed columns.

    Called twice with the same dimension for two roles (pickup / dropoff).
    """
    d = dim.select(
        F.col(dim_key).alias("__lk_key"), *[F.col(k).alias(v) for k, v in rename.items()]
    )
    return fact.join(d, fact[fact_key] == d["__lk_key"], how).drop("__lk_key")


def attach_profile_by_zone(
    fact: DataFrame,
    profile: DataFrame,
    shared_on: Mapping[str, str],
    zone_col: str,
    roles: Mapping[str, tuple[str, Mapping[str, str]]],
) -> DataFrame:
    """One profile, several zone roles, one join.

    ``profile`` has one row per (``zone_col``, shared keys). It is reshaped to one
    row per shared key with a map ``zone -> metrics`` (at most as many entries as
    there are zones), joined once, and each role reads its
    zone from the map. Equivalent to one left join per role on
    (role zone column, shared keys), but the profile is computed and joined once.

    ``shared_on``: fact column -> profile column (e.g. pickup weekday/hour);
    ``roles``: role name -> (fact zone column, {profile metric: output column}).
    """
    metric_cols = sorted({m for _, metrics in roles.values() for m in metrics})
    tmp = {pc: f"__ps_{i}" for i, pc in enumerate(shared_on.values())}
    by_key = (
        profile.filter(F.col(zone_col).isNotNull())
        .groupBy(*[F.col(pc).alias(tmp[pc]) for pc in shared_on.values()])
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct(F.col(zone_col), F.struct(*[F.col(m) for m in metric_cols])))
            ).alias("__pm")
        )
    )
    cond = None
    for fc, pc in shared_on.items():
        c = fact[fc] == F.col(tmp[pc])
        cond = c if cond is None else cond & c
    j = fact.join(by_key, cond, "left")
    outs = []
    for fact_zone, metrics in roles.values():
        hit = F.try_element_at(F.col("__pm"), F.col(fact_zone))
        outs += [hit[m].alias(out) for m, out in metrics.items()]
    return j.select(*fact.columns, *outs)


def filter_cross_zone(df: DataFrame, a: str = "pickup_boro", b: str = "dropoff_boro") -> DataFrame:
    """Trips whose two ends lie in different zones (NULL ends are excluded)."""
    return df.filter(F.col(a) != F.col(b))


def join_audit(before: DataFrame, after: DataFrame, unmatched_cols: list[str]) -> DataFrame:
    """Long-form audit ``(metric, value)``: rows before, rows after, and the number
    of rows whose joined column stayed NULL. Two one-row aggregates, no join."""
    b = before.agg(F.count(F.lit(1)).alias("rows_before"))
    a = after.agg(
        F.count(F.lit(1)).alias("rows_after"),
        *[F.count_if(F.col(c).isNull()).alias(f"unmatched_{c}") for c in unmatched_cols],
    )

    def long(df: DataFrame) -> DataFrame:
        pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
        return df.selectExpr(f"stack({len(df.columns)}, {pairs}) as (metric, value)")

    return long(b).unionByName(long(a))
