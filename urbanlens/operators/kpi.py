"""KPI tables, correlations and report shaping.

KPI aggregates are hash aggregates with a partial (map-side) phase, so only one
row per key per task is shuffled; a key holding a third of all trips costs no
more shuffle than any other key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# (output name, input column, digits) for rounded averages.
AvgSpec = tuple[str, str, int]

# The congestion report's metrics (name, column, rounding digits).
HOUR_BIN_METRICS: tuple[AvgSpec, ...] = (
    ("avg_fare", "fare_amount", 2),
    ("avg_duration_min", "trip_duration", 2),
    ("avg_velocity", "average_velocity", 4),
    ("avg_traffic_volume", "pickup_avg_median_volume", 2),
    ("avg_congestion_surcharge", "congestion_surcharge", 3),
    ("avg_cbd_fee", "cbd_congestion_fee", 3),
)
ZONE_METRICS: tuple[AvgSpec, ...] = HOUR_BIN_METRICS[:5]
ZONE_PERIOD_METRICS: tuple[AvgSpec, ...] = HOUR_BIN_METRICS[:4]
# Scored summaries of the fare model.
SCORED_HOUR_BIN_METRICS: tuple[AvgSpec, ...] = (
    ("avg_actual_fare", "fare_amount", 2),
    ("avg_predicted_fare", "prediction", 2),
    ("avg_pickup_traffic_vol", "pickup_avg_median_volume", 1),
    ("avg_velocity", "average_velocity", 3),
)
SCORED_ZONE_METRICS: tuple[AvgSpec, ...] = (
    ("avg_actual_fare", "fare_amount", 2),
    ("avg_traffic_vol", "pickup_avg_median_volume", 1),
    ("avg_trip_duration_min", "trip_duration", 2),
)
# Features correlated with the fare (output name -> column).
FARE_CORRELATES: dict[str, str] = {
    "traffic_volume": "pickup_avg_median_volume",
    "velocity": "average_velocity",
    "trip_duration": "trip_duration",
    "trip_distance": "trip_distance",
    "traffic_x_distance": "traffic_distance_interaction",
}
# Business order of the hour bins in reports.
HOUR_BIN_ORDER: tuple[str, ...] = ("Morning_Rush", "Off_Peak_Day", "Evening_Rush", "Late_Night_Off_Peak")


def kpi(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[AvgSpec],
    count_alias: str = "trip_count",
    order_by: Sequence[Column] | None = None,
) -> DataFrame:
    """Count plus rounded averages per key, optionally ordered."""
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count_alias),
        *[F.round(F.avg(c), d).alias(name) for name, c, d in metrics],
    )
    return out.orderBy(*order_by) if order_by else out


def correlations(
    df: DataFrame,
    features: Mapping[str, str] = FARE_CORRELATES,
    target: str = "fare_amount",
    digits: int | None = 6,
) -> DataFrame:
    """Pearson r of each feature with ``target`` in one pass (one row).

    ``covar_samp / (stddev_x * stddev_y)`` through ``try_divide``: a constant
    column gives NULL instead of an ANSI division-by-zero error.
    """
    aggs = []
    for name, c in features.items():
        pair = F.col(c).isNotNull() & F.col(target).isNotNull()
        x = F.when(pair, F.col(c))
        y = F.when(pair, F.col(target))
        r = F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))
        aggs.append((F.round(r, digits) if digits is not None else r).alias(name))
    return df.agg(*aggs)


def pivot_metric(
    df: DataFrame, row: str, col: str, values: Sequence[str], metric: str
) -> DataFrame:
    """Rows of ``row``; one column per listed value of ``col`` holding ``metric``.

    Listing the pivot values avoids the extra job that discovers them.
    """
    return df.groupBy(row).pivot(col, list(values)).agg(F.max(metric))


def reindex(
    spark: SparkSession, df: DataFrame, col: str, order: Sequence[str], ord_alias: str = "report_order"
) -> DataFrame:
    """Rows in a fixed category order; absent categories appear with NULL metrics.

    The order table is as large as ``order`` (a handful of labels) and ``df`` is a
    report; the optimizer broadcasts whichever side it can for the outer join.
    """
    labels = F.array(*[F.struct(F.lit(v).alias(col), F.lit(i + 1).alias(ord_alias)) for i, v in enumerate(order)])
    cats = spark.range(1).select(F.inline(labels))
    return cats.join(df, col, "left").orderBy(ord_alias)


def top_n(df: DataFrame, by: str, n: int, tiebreak: Sequence[str] = (), ascending: bool = False) -> DataFrame:
    """First ``n`` rows by ``by`` (ties broken by ``tiebreak`` ascending).

    Plans as ``TakeOrderedAndProject``: each task keeps its own top n.
    """
    primary = F.asc(by) if ascending else F.desc(by)
    return df.orderBy(primary, *[F.asc(t) for t in tiebreak]).limit(n)


def bottom_n(df: DataFrame, by: str, n: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    return top_n(df, by, n, tiebreak, ascending=True)


# --- several reports from one scan: mergeable moments in cells, GROUPING SETS over the cells
def moment_cells(df: DataFrame, keys: Sequence[str], averaged: Sequence[str], correlated: Mapping[str, str] | None = None, target: str = "fare_amount") -> DataFrame:
    """One row per combination of ``keys``, by one aggregate over ``df``: the number of rows ``n``, sum and count of
    each ``averaged`` column, and for each pair of a ``correlated`` column and ``target`` their number, means and
    centred products. Such rows merge to those of any coarser grouping."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in averaged:
        aggs += [F.sum(c).alias(f"{c}__sum"), F.count(c).alias(f"{c}__n")]
    for name, c in (correlated or {}).items():
        pair = F.col(c).isNotNull() & F.col(target).isNotNull()
        x, y = (F.when(pair, F.col(k).cast("double")) for k in (c, target))
        n = F.count(x)
        aggs += [
            n.alias(f"{name}__pairs"), F.avg(x).alias(f"{name}__x"), F.avg(y).alias(f"{name}__y"),
            (F.var_pop(x) * n).alias(f"{name}__xx"), (F.var_pop(y) * n).alias(f"{name}__yy"), (F.covar_pop(x, y) * n).alias(f"{name}__xy"),
        ]
    return df.groupBy(*keys).agg(*aggs)


def merged_mean(column: str, digits: int) -> Column:
    return F.round(F.try_divide(F.sum(f"{column}__sum"), F.sum(f"{column}__n")), digits)


def merged_correlation(name: str, digits: int | None = 6) -> Column:
    """Pearson r of cells together: products about the cells' means, and of the means about the whole's."""
    n, x, y = (F.col(f"{name}__{k}") for k in ("pairs", "x", "y"))
    total = F.sum(n)

    def product(own: str, a: Column, b: Column) -> Column:
        return F.sum(f"{name}__{own}") + F.sum(n * a * b) - F.try_divide(F.sum(n * a) * F.sum(n * b), total)

    r = F.try_divide(product("xy", x, y), F.sqrt(F.greatest(product("xx", x, x), F.lit(0.0)) * F.greatest(product("yy", y, y), F.lit(0.0))))
    return F.round(r, digits) if digits is not None else r
