"""Queries of the catalogue over tree ensembles, single-scan reports, selection and sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.operators import forest, kpi, profile, selection, sketches
from urbanlens.plans import jobs
from urbanlens.plans.catalog import _PERIOD, Inputs, _sensor_sql, _trip_sql, register
from urbanlens.session import cut_lineage, stored
from urbanlens.sources.testdata import with_views

# ---- a small pinned forest (J3-J5, J7) ------------------------------------------
# Three trees over four features, with ordered and categorical splits.
PINNED_FEATURES = ("trip_distance", "trip_duration", "pickup_hour", "pickup_avg_median_volume")
PINNED_FOREST = (
    forest.Node(0, 0, 400.0, feature=0, threshold=44.0, below=1, above=2),
    forest.Node(0, 1, 250.0, feature=1, threshold=30.5, below=3, above=4),
    forest.Node(0, 2, 550.0, feature=2, categories=(7.0, 8.0, 9.0, 16.0, 17.0, 18.0, 19.0), below=5, above=6),
    forest.Node(0, 3, 120.25),
    forest.Node(0, 4, 310.5),
    forest.Node(0, 5, 610.75),
    forest.Node(0, 6, 505.0),
    forest.Node(1, 0, 380.0, feature=1, threshold=60.0, below=1, above=2),
    forest.Node(1, 1, 260.0, feature=3, threshold=480.0, below=3, above=4),
    forest.Node(1, 2, 520.0, feature=0, threshold=88.0, below=5, above=6),
    forest.Node(1, 3, 205.5),
    forest.Node(1, 4, 290.0),
    forest.Node(1, 5, 480.0, feature=2, threshold=11.0, below=7, above=8),
    forest.Node(1, 6, 700.125),
    forest.Node(1, 7, 470.0),
    forest.Node(1, 8, 495.5),
    forest.Node(2, 0, 333.25),
)


@register("forest_predictions", "SELECT * FROM (" + _trip_sql(f"""
, nodes AS (SELECT * FROM {forest.nodes_sql(PINNED_FOREST)}),
x AS (SELECT row_number() OVER () AS r, trip_id, [{', '.join(f'CAST({c} AS DOUBLE)' for c in PINNED_FEATURES)}] AS x FROM consolidated),
walk(r, x, tree, node, prediction, done) AS (
  SELECT r, x, tree, node, prediction, feature IS NULL FROM x, nodes WHERE node = 0
  UNION ALL
  SELECT w.r, w.x, w.tree, m.node, m.prediction, m.feature IS NULL
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node
  JOIN nodes m ON m.tree = n.tree AND m.node = CASE WHEN (n.categories IS NULL AND w.x[n.feature + 1] <= n.threshold)
    OR (n.categories IS NOT NULL AND list_contains(n.categories, w.x[n.feature + 1])) THEN n.below ELSE n.above END
  WHERE NOT w.done)
SELECT x.trip_id, round(avg(w.prediction), 6) AS prediction FROM walk w JOIN x USING (r) WHERE w.done GROUP BY x.r, x.trip_id
""").replace("WITH ", "WITH RECURSIVE ", 1) + ")")
def _forest_predictions(i: Inputs) -> DataFrame:
    inputs = [F.col(c).cast("double") for c in PINNED_FEATURES]
    return i.consolidated.select("trip_id", F.round(forest.prediction(PINNED_FOREST, inputs), 6).alias("prediction"))


# ---- the congestion report from one scan (P4, D6-D9) -----------------------------
def _report_sql() -> str:
    every = [n for n, _, _ in kpi.HOUR_BIN_METRICS]

    def part(name: str, keys: dict[str, str], metrics, correlated: bool = False) -> str:
        known = {n: f"round(avg({c}), {d})" for n, c, d in metrics}
        columns = [f"'{name}' AS report", *(f"CAST({keys.get(k, 'NULL')} AS VARCHAR) AS {k}" for k in ("Hour_Bin", "pickup_boro", "period")), "CAST(count(*) AS BIGINT) AS trip_count"]
        columns += [f"{known.get(n, 'CAST(NULL AS DOUBLE)')} AS {n}" for n in every]
        columns += [f"{f'round(corr(fare_amount, {c}), 6)' if correlated else 'CAST(NULL AS DOUBLE)'} AS corr_{n}" for n, c in kpi.FARE_CORRELATES.items()]
        return f"SELECT {', '.join(columns)} FROM (SELECT *, {_PERIOD} AS period FROM consolidated)" + (f" GROUP BY {', '.join(keys.values())}" if keys else "")

    return "\nUNION ALL\n".join([
        part("by_hour_bin", {"Hour_Bin": "Hour_Bin"}, kpi.HOUR_BIN_METRICS), part("by_zone", {"pickup_boro": "pickup_boro"}, kpi.ZONE_METRICS),
        part("by_zone_period", {"pickup_boro": "pickup_boro", "period": "period"}, kpi.ZONE_PERIOD_METRICS), part("correlations", {}, (), True),
    ])


@register("congestion_report_one_scan", _trip_sql(_report_sql()))
def _report_one_scan(i: Inputs) -> DataFrame:
    return jobs.congestion_tables(jobs.report_cells(i.consolidated))


# ---- exact quantiles by selection (D4, D15) --------------------------------------
_QUARTILES = (0.25, 0.5, 0.75)


@register("fare_quartiles_by_selection", with_views("\nUNION ALL\n".join(
    f"SELECT payment_type, CAST({q} AS DOUBLE) AS fraction, quantile_disc(fare_amount, {q}) AS value FROM trips GROUP BY payment_type" for q in _QUARTILES), "trips"))
def _fare_quartiles(i: Inputs) -> DataFrame:
    return selection.select_quantiles(i.trips, ["payment_type"], "fare_amount", _QUARTILES, few=500)


@register("sensor_median_profile_selection", _sensor_sql("SELECT * FROM sensor_profile", "sensor_profile"))
def _profile_selection(i: Inputs) -> DataFrame:
    return profile.median_profile(jobs.clean_sensors(i.sensors), method="select")


# ---- mergeable sketches beside exact figures (D1-D3, D10, D12-D14) ------------------
_SKETCHED = ("fare_amount", "trip_distance", "total_amount", "PULocationID", "payment_type", "passenger_count")
_NUMBERS = ("fare_amount", "trip_distance", "total_amount", "passenger_count")


@register("sketch_report_trips", with_views("\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, CAST(count(*) AS BIGINT) AS n_rows, CAST(count_if({c} IS NULL) AS BIGINT) AS nulls,
       {f'CAST(min({c}) AS DOUBLE)' if c in _NUMBERS else 'CAST(NULL AS DOUBLE)'} AS least, {f'CAST(max({c}) AS DOUBLE)' if c in _NUMBERS else 'CAST(NULL AS DOUBLE)'} AS most,
       {f'round(avg({c}), 6)' if c in _NUMBERS else 'CAST(NULL AS DOUBLE)'} AS mean, {f'round(stddev_samp({c}), 6)' if c in _NUMBERS else 'CAST(NULL AS DOUBLE)'} AS stddev,
       CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct, TRUE AS distinct_in_bounds, {'TRUE' if c in _NUMBERS else 'CAST(NULL AS BOOLEAN)'} AS quantiles_in_bounds
FROM trips""" for c in _SKETCHED), "trips"))
def _sketch_report(i: Inputs) -> DataFrame:
    """The sketches of the trips of each payment type, merged, with checks of the estimates against exact figures."""
    trips = stored(i.trips.select(*_SKETCHED))  # the joins run once
    parts = sketches.sketch(trips, _SKETCHED, numeric=_NUMBERS, by=["payment_type"])
    # a few rows, used for the bounds and for the report
    return sketches.checked(trips, cut_lineage(sketches.report(sketches.merge(parts))), numeric=_NUMBERS)


_COUNTED = ("payment_type", "PULocationID", "RatecodeID")


@register("frequent_values_by_sketch", with_views("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS item, CAST(count(*) AS BIGINT) AS n_rows FROM trips WHERE {c} IS NOT NULL GROUP BY {c}" for c in _COUNTED), "trips"))
def _frequent(i: Inputs) -> DataFrame:
    """Sketches per weekday of pickup, merged: exact, as these columns have few values."""
    parts = sketches.sketch(i.trips.withColumn("day", F.weekday("tpep_pickup_datetime")), _COUNTED, by=["day"])
    found = sketches.report(sketches.merge(parts), frequent=100)
    return found.select("column_name", F.explode("frequent").alias("f")).select("column_name", "f.item", F.col("f.count").alias("n_rows"))
