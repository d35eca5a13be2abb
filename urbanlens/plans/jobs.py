"""Composite jobs (P1–P10), each a function of input DataFrames.

Callers compose the returned DataFrames and Spark optimises each plan as a whole; the
writers live in ``plans.run``. Only ``fare_model`` (it fits and scores) and what says
that it is written once trigger actions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.functions import (
    day_of_week,
    duration_minutes,
    guarded_ratio,
    hour_bin,
    make_timestamp,
    nullify_sentinels,
    parse_int,
    period,
    weekend_flag,
)
from urbanlens.operators import cleaning, enrich, kpi, model, profile, quality
from urbanlens.operators.sampling import hash_split
from urbanlens.session import cut_lineage, release
from urbanlens.sources import sinks, versions

# The profile columns that must be present after consolidation.
PROFILE_REQUIRED = ("pickup_avg_median_volume", "dropoff_avg_median_volume")


# ----------------------------------------------------------------------- P1 trips
def clean_trips(raw: DataFrame) -> DataFrame:
    """Validity filter, then constant imputation (filter first, as surveyed)."""
    return cleaning.impute_constants(cleaning.filter_valid(raw, cleaning.TRIP_BOUNDS))


def cleaning_counts(raw: DataFrame) -> DataFrame:
    """Rows before / after cleaning in one pass."""
    return quality.rows_removed(raw, cleaning.bounds_predicate(cleaning.TRIP_BOUNDS))


# --------------------------------------------------------------------- P2 sensors
def parse_sensor_volumes(raw: DataFrame) -> DataFrame:
    """Text volume -> int, error codes -> NULL."""
    return raw.withColumn("Vol_numeric", nullify_sentinels(parse_int("Vol")))


def clean_sensors(raw: DataFrame) -> DataFrame:
    """Parsed volumes, required anchors, assembled timestamp and weekday."""
    df = cleaning.require_not_null(parse_sensor_volumes(raw), ["SegmentID", "Boro"])
    ts = make_timestamp("Yr", "M", "D", "HH", "MM")
    return df.withColumn("traffic_timestamp", ts).withColumn("day_of_week", day_of_week("traffic_timestamp"))


def sensor_profile(raw: DataFrame, method: str = "exact") -> DataFrame:
    return profile.median_profile(clean_sensors(raw), method=method)


def zone_profile(raw_sensors: DataFrame, method: str = "exact") -> DataFrame:
    """(Boro, weekday, hour) profile: at most boroughs × 7 × 24 rows."""
    return profile.rollup_profile(sensor_profile(raw_sensors, method))


# ----------------------------------------------------------------- P3 consolidate
def with_pickup_keys(trips: DataFrame) -> DataFrame:
    return trips.withColumn("pickup_hour", F.hour("tpep_pickup_datetime")).withColumn(
        "pickup_day_of_week", day_of_week("tpep_pickup_datetime")
    )


def with_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Pickup and dropoff borough names from one lookup in two roles."""
    t = enrich.lookup(trips, zones, "PULocationID", "LocationID", {"Boro_Name": "pickup_boro"})
    return enrich.lookup(t, zones, "DOLocationID", "LocationID", {"Boro_Name": "dropoff_boro"})


def with_profiles(trips: DataFrame, zprofile: DataFrame) -> DataFrame:
    """Pickup profile (3 metrics) and dropoff profile (2 metrics); the dropoff
    side is matched on the *pickup* weekday and hour (C3, C4). Both roles read
    one broadcast copy of the profile keyed by (weekday, hour)."""
    return enrich.attach_profile_by_zone(
        trips,
        zprofile,
        shared_on={"pickup_day_of_week": "day_of_week", "pickup_hour": "HH"},
        zone_col="Boro",
        roles={
            "pickup": ("pickup_boro", {
                "boro_avg_median_volume": "pickup_avg_median_volume",
                "boro_max_volume": "pickup_max_volume",
                "boro_volume_stddev": "pickup_volume_stddev",
            }),
            "dropoff": ("dropoff_boro", {
                "boro_avg_median_volume": "dropoff_avg_median_volume",
                "boro_max_volume": "dropoff_max_volume",
            }),
        },
    )


def with_time_features(df: DataFrame) -> DataFrame:
    return df.withColumn("Is_Weekend", weekend_flag("pickup_day_of_week")).withColumn(
        "Hour_Bin", hour_bin("pickup_hour")
    )


def with_trip_dynamics(df: DataFrame) -> DataFrame:
    """Duration (min), velocity (miles/min, 0 when duration <= 0), and
    distance × pickup traffic (H8–H10)."""
    return (
        df.withColumn("trip_duration", duration_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime"))
        .withColumn("average_velocity", guarded_ratio("trip_distance", "trip_duration"))
        .withColumn("traffic_distance_interaction", F.col("trip_distance") * F.col("pickup_avg_median_volume"))
    )


def enrich_trips(clean: DataFrame, zones: DataFrame, zprofile: DataFrame) -> DataFrame:
    """All feature columns, before guardrails."""
    return with_trip_dynamics(with_time_features(with_profiles(with_zones(with_pickup_keys(clean), zones), zprofile)))


def apply_guardrails(df: DataFrame) -> DataFrame:
    return cleaning.filter_valid(df, cleaning.GUARDRAIL_BOUNDS)


def consolidate(clean: DataFrame, zones: DataFrame, zprofile: DataFrame) -> DataFrame:
    """Feature table: enriched, inside guardrails, both profiles present."""
    return apply_guardrails(enrich_trips(clean, zones, zprofile)).dropna(subset=list(PROFILE_REQUIRED))


# ------------------------------------------------------------------- P4 report
def with_period(df: DataFrame) -> DataFrame:
    return df.withColumn("period", period("Hour_Bin"))


def kpi_by_hour_bin(features: DataFrame) -> DataFrame:
    return kpi.kpi(features, ["Hour_Bin"], kpi.HOUR_BIN_METRICS, order_by=[F.desc("avg_fare")])


def kpi_by_zone(features: DataFrame) -> DataFrame:
    return kpi.kpi(features, ["pickup_boro"], kpi.ZONE_METRICS, order_by=[F.desc("avg_fare")])


def kpi_by_zone_period(features: DataFrame) -> DataFrame:
    return kpi.kpi(
        with_period(features), ["pickup_boro", "period"], kpi.ZONE_PERIOD_METRICS,
        order_by=[F.asc("pickup_boro"), F.asc("period")],
    )


@dataclass
class CongestionReport:
    by_hour_bin: DataFrame
    by_zone: DataFrame
    by_zone_period: DataFrame
    correlations: DataFrame

    def write(self, out_dir: str) -> None:
        for name in ("by_hour_bin", "by_zone", "by_zone_period", "correlations"):
            sinks.write_report_csv(getattr(self, name), f"{out_dir}/{name}")


# Columns the congestion report reads (everything else is pruned at the scan).
REPORT_COLUMNS = tuple(sorted(
    {c for _, c, _ in kpi.HOUR_BIN_METRICS} | set(kpi.FARE_CORRELATES.values())
    | {"fare_amount", "Hour_Bin", "pickup_boro"}
))


def report_cells(features: DataFrame) -> DataFrame:
    """Moments by hour bin and zone: all that the congestion report needs, from one scan."""
    averaged = list(dict.fromkeys(c for _, c, _ in kpi.HOUR_BIN_METRICS))
    return with_period(kpi.moment_cells(features, ["Hour_Bin", "pickup_boro"], averaged, kpi.FARE_CORRELATES))


def congestion_tables(cells: DataFrame) -> DataFrame:
    """The report's four tables as one, by GROUPING SETS over the cells: ``report`` names a row's table, and
    what that table does not have is NULL."""
    named = {"by_hour_bin": kpi.HOUR_BIN_METRICS, "by_zone": kpi.ZONE_METRICS, "by_zone_period": kpi.ZONE_PERIOD_METRICS}
    keys = ["Hour_Bin", "pickup_boro", "period"]
    sets = [["Hour_Bin"], ["pickup_boro"], ["pickup_boro", "period"], []]
    found = cells.groupingSets(sets, *keys).agg(
        F.grouping_id().alias("set"), F.sum("n").alias("trip_count"),
        *[kpi.merged_mean(c, d).alias(n) for n, c, d in kpi.HOUR_BIN_METRICS],
        *[kpi.merged_correlation(n).alias(f"corr_{n}") for n in kpi.FARE_CORRELATES],
    )
    report = F.when(F.col("set") == 3, "by_hour_bin").when(F.col("set") == 5, "by_zone").when(F.col("set") == 4, "by_zone_period").otherwise("correlations")
    rows = found.withColumn("report", report)
    # a total of nothing is no table of KPIs
    has = lambda name: F.col("report").isin([r for r, m in named.items() if name in [n for n, _, _ in m]])
    return rows.select(
        "report", *keys, F.coalesce("trip_count", F.lit(0)).alias("trip_count"), *[F.when(has(n), F.col(n)).alias(n) for n, _, _ in kpi.HOUR_BIN_METRICS],
        *[F.when(F.col("report") == "correlations", F.col(f"corr_{n}")).alias(f"corr_{n}") for n in kpi.FARE_CORRELATES],
    )


def congestion_report(features: DataFrame) -> CongestionReport:
    """P4. One scan of the pruned input makes the cells, which are written once; the tables come from them."""
    tables = congestion_tables(cut_lineage(report_cells(features.select(*REPORT_COLUMNS))))

    def table(name: str, keys: list[str], metrics) -> DataFrame:
        return tables.where(F.col("report") == name).select(*keys, "trip_count", *[n for n, _, _ in metrics])

    return CongestionReport(
        table("by_hour_bin", ["Hour_Bin"], kpi.HOUR_BIN_METRICS).orderBy(F.desc("avg_fare")),
        table("by_zone", ["pickup_boro"], kpi.ZONE_METRICS).orderBy(F.desc("avg_fare")),
        table("by_zone_period", ["pickup_boro", "period"], kpi.ZONE_PERIOD_METRICS).orderBy("pickup_boro", "period"),
        tables.where("report = 'correlations'").select(*[F.col(f"corr_{n}").alias(n) for n in kpi.FARE_CORRELATES]),
    )


# ------------------------------------------------------------------- P7 charts
def peak_offpeak_by_zone(features: DataFrame, exclude: tuple[str, ...] = (), min_rows: int | None = None) -> DataFrame:
    """Average fare at peak vs off-peak, one row per pickup zone."""
    t = cleaning.exclude_values(kpi_by_zone_period(features), "pickup_boro", exclude, min_rows)
    return kpi.pivot_metric(t, "pickup_boro", "period", ["Peak", "Off_Peak"], "avg_fare")


def hour_bin_report(spark: SparkSession, features: DataFrame) -> DataFrame:
    """KPI by hour bin in business order, absent bins as NULL rows."""
    return kpi.reindex(spark, kpi_by_hour_bin(features), "Hour_Bin", kpi.HOUR_BIN_ORDER)


# -------------------------------------------------------------------- P5 model
@dataclass
class FareModel:
    model: PipelineModel
    predictions: DataFrame
    metrics: DataFrame
    importance: DataFrame
    scored_by_hour_bin: DataFrame
    scored_by_zone: DataFrame


def fare_reports(spark: SparkSession, fitted: PipelineModel, pred: DataFrame) -> FareModel:
    """Everything that is reported of a fitted model and the scored test side."""
    return FareModel(
        model=fitted,
        predictions=pred,
        metrics=model.evaluate(pred),
        importance=model.importance_table(spark, fitted),
        scored_by_hour_bin=kpi.kpi(
            pred, ["Hour_Bin"], kpi.SCORED_HOUR_BIN_METRICS, "num_trips", [F.desc("avg_pickup_traffic_vol")]
        ),
        scored_by_zone=kpi.kpi(
            pred, ["pickup_boro"], kpi.SCORED_ZONE_METRICS, "num_trips", [F.desc("avg_traffic_vol")]
        ),
    )


def fare_model(spark: SparkSession, features: DataFrame, seed: int = 42, **forest_params) -> FareModel:
    """Train on a deterministic 80 % md5 split, score the rest (P5). The split is by
    trip_id on purpose: trips that share an id stay on one side."""
    # the joins behind the features run once, and the test side is scored once
    frame = cut_lineage(model.model_frame(features))
    release(spark)  # the joins' shuffles, before the fit keeps its rows
    train, test = hash_split(frame, ["trip_id"], 0.8, seed)
    fitted = model.feature_pipeline(**forest_params).fit(train)
    pred = cut_lineage(fitted.transform(test).drop("features", "rawPrediction"))
    return fare_reports(spark, fitted, pred)


def stored_fare_model(
    spark: SparkSession, features: Callable[[], DataFrame], root: str, inputs: Mapping[str, str], seed: int = 42, **forest_params
) -> str:
    """Folder with ``model`` and the scored test side ``predictions``, fitted once for these
    ``inputs`` (named paths) and parameters; ``features`` is called only if it must be fitted."""

    def write(folder: str) -> None:
        made = fare_model(spark, features(), seed, **forest_params)
        sinks.save_model(made.model, f"{folder}/model")
        sinks.write_parquet(made.predictions, f"{folder}/predictions")

    return versions.build(spark, root, inputs, write, {"seed": seed, **model.FOREST_PARAMS, **forest_params})


def read_fare_model(spark: SparkSession, folder: str) -> FareModel:
    return fare_reports(spark, PipelineModel.load(f"{folder}/model"), spark.read.parquet(f"{folder}/predictions"))


# ---------------------------------------------------------------- P6 quality
# Columns described by the inspection.
DESCRIBED_TRIP_COLUMNS = ("fare_amount", "trip_distance", "passenger_count", "total_amount")
DESCRIBED_FEATURES = ("fare_amount", "trip_distance", "trip_duration", "average_velocity", "pickup_avg_median_volume", "dropoff_avg_median_volume")


# Trip rule checks of the EDA (name -> predicate).
def trip_rules() -> dict:
    return {
        "nonpositive_fare": F.col("fare_amount") <= 0,
        "nonpositive_distance": F.col("trip_distance") <= 0,
        "zero_passengers": F.col("passenger_count") == 0,
        "fare_over_500": F.col("fare_amount") > 500,
        "distance_over_100": F.col("trip_distance") > 100,
    }


def sensor_rules() -> dict:
    """Checks on the parsed volume (comparing the raw text would fail under ANSI)."""
    v = parse_int("Vol")
    return {
        "unparseable_volume": F.col("Vol").isNotNull() & v.isNull(),
        "negative_volume": v < 0,
        "zero_volume": v == 0,
        "sentinel_999": v == 999,
    }
