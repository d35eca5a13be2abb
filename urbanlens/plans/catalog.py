"""Query catalogue: every registered query as a Spark plan over the driver
tables, and (where SQL can express it) an independent DuckDB formulation.

Spark side: ``QUERIES[name](spark, sf_dir) -> DataFrame``.
Oracle side: ``ORACLE_SQL[name]`` — one SQL string over the pre-registered
tables. Column names match; integer/float types are cast explicitly where the
two engines differ (Spark ``int`` vs DuckDB ``BIGINT``/``HUGEINT``). Floating
averages are rounded in both so summation order cannot change a hash.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.functions import malformed_numeric
from urbanlens.functions.hashing import hash_threshold
from urbanlens.operators import cleaning, enrich, kpi, model, profile, quality, recsys, text
from urbanlens.operators.sampling import hash_split_label
from urbanlens.plans import jobs
from urbanlens.session import checkpoint_dir
from urbanlens.sources import testdata
from urbanlens.sources.testdata import with_views

SPLIT_FRACTION = 0.8
SEED = 42


class Inputs:
    """Lazily built views over one test-data directory (plans only, no actions)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def trips(self) -> DataFrame:
        return testdata.trips(self.spark, self.sf_dir)

    @cached_property
    def zones(self) -> DataFrame:
        return testdata.zones(self.spark, self.sf_dir)

    @cached_property
    def sensors(self) -> DataFrame:
        return testdata.sensors(self.spark, self.sf_dir)

    @cached_property
    def clean(self) -> DataFrame:
        return jobs.clean_trips(self.trips)

    @cached_property
    def zprofile(self) -> DataFrame:
        return jobs.zone_profile(self.sensors)

    @cached_property
    def zoned(self) -> DataFrame:
        return jobs.with_zones(jobs.with_pickup_keys(self.clean), self.zones)

    @cached_property
    def profiled(self) -> DataFrame:
        return jobs.with_profiles(self.zoned, self.zprofile)

    @cached_property
    def enriched(self) -> DataFrame:
        return jobs.with_trip_dynamics(jobs.with_time_features(self.profiled))

    @cached_property
    def consolidated(self) -> DataFrame:
        # same plan as jobs.consolidate(clean, zones, zprofile), reusing `enriched`
        return jobs.apply_guardrails(self.enriched).dropna(subset=list(jobs.PROFILE_REQUIRED))

    @cached_property
    def ratings(self) -> DataFrame:
        return testdata.ratings(self.spark, self.sf_dir)

    @cached_property
    def movies(self) -> DataFrame:
        return testdata.movies(self.spark, self.sf_dir)

    @cached_property
    def vectors(self) -> DataFrame:
        return testdata.vectors(self.spark, self.sf_dir)

    @cached_property
    def slices(self) -> recsys.Slices:
        return recsys.Slices(testdata.FIRST_DAY, testdata.LAST_DAYS)


# ------------------------------------------------------------------- SQL stages
_CLEAN = """clean AS (
  SELECT * REPLACE (
    coalesce(RatecodeID, 1.0::DOUBLE) AS RatecodeID,
    coalesce(store_and_fwd_flag, 'N') AS store_and_fwd_flag,
    coalesce(congestion_surcharge, 0.0::DOUBLE) AS congestion_surcharge,
    coalesce(Airport_fee, 0.0::DOUBLE) AS Airport_fee)
  FROM trips
  WHERE fare_amount > 0 AND fare_amount <= 800 AND trip_distance > 0 AND trip_distance <= 100
    AND passenger_count IS NOT NULL AND passenger_count > 0
)"""
_SENSORS_PARSED = """sensors_parsed AS (
  SELECT * EXCLUDE (v), CASE WHEN v < 0 OR v = 999 THEN NULL ELSE v END AS Vol_numeric
  FROM (SELECT *, TRY_CAST(regexp_replace(Vol, ',', '', 'g') AS INTEGER) AS v FROM sensors)
)"""
_SENSORS_CLEAN = """sensors_clean AS (
  SELECT *, CAST(dayofweek(traffic_timestamp) + 1 AS INTEGER) AS day_of_week FROM (
    SELECT *, try_strptime(concat_ws(' ', concat_ws('-', Yr, M, D), concat_ws(':', HH, MM, '00')),
                           '%Y-%m-%d %H:%M:%S') AS traffic_timestamp
    FROM sensors_parsed WHERE SegmentID IS NOT NULL AND Boro IS NOT NULL)
)"""
_SENSOR_PROFILE = """sensor_profile AS (
  SELECT SegmentID, Boro, street, day_of_week, HH,
         CAST(quantile_disc(Vol_numeric, 0.5) AS INTEGER) AS historical_median_volume
  FROM sensors_clean GROUP BY SegmentID, Boro, street, day_of_week, HH
)"""
_ZONE_PROFILE = """zone_profile AS (
  SELECT Boro, day_of_week, HH,
         round(avg(historical_median_volume)) AS boro_avg_median_volume,
         max(historical_median_volume) AS boro_max_volume,
         round(stddev_samp(historical_median_volume)) AS boro_volume_stddev
  FROM sensor_profile GROUP BY Boro, day_of_week, HH
)"""
_ZONED = """zoned AS (
  SELECT t.*, CAST(hour(t.tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
         CAST(dayofweek(t.tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_day_of_week,
         zp.Boro_Name AS pickup_boro, zd.Boro_Name AS dropoff_boro
  FROM clean t
  LEFT JOIN zones zp ON t.PULocationID = zp.LocationID
  LEFT JOIN zones zd ON t.DOLocationID = zd.LocationID
)"""
_PROFILED = """profiled AS (
  SELECT z.*, p.boro_avg_median_volume AS pickup_avg_median_volume, p.boro_max_volume AS pickup_max_volume,
         p.boro_volume_stddev AS pickup_volume_stddev,
         d.boro_avg_median_volume AS dropoff_avg_median_volume, d.boro_max_volume AS dropoff_max_volume
  FROM zoned z
  LEFT JOIN zone_profile p ON z.pickup_boro = p.Boro AND z.pickup_day_of_week = p.day_of_week AND z.pickup_hour = p.HH
  LEFT JOIN zone_profile d ON z.dropoff_boro = d.Boro AND z.pickup_day_of_week = d.day_of_week AND z.pickup_hour = d.HH
)"""
_ENRICHED = """enriched AS (
  SELECT *, CASE WHEN trip_duration > 0 THEN trip_distance / trip_duration ELSE 0.0::DOUBLE END AS average_velocity,
         trip_distance * pickup_avg_median_volume AS traffic_distance_interaction
  FROM (
    SELECT *, CASE WHEN pickup_day_of_week IN (1, 7) THEN 1 ELSE 0 END AS Is_Weekend,
      CASE WHEN pickup_hour >= 7 AND pickup_hour < 10 THEN 'Morning_Rush'
           WHEN pickup_hour >= 10 AND pickup_hour < 16 THEN 'Off_Peak_Day'
           WHEN pickup_hour >= 16 AND pickup_hour < 20 THEN 'Evening_Rush'
           ELSE 'Late_Night_Off_Peak' END AS Hour_Bin,
      CAST(epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime) AS DOUBLE) / 60.0::DOUBLE AS trip_duration
    FROM profiled)
)"""
_GUARDED = """guarded AS (
  SELECT * FROM enriched
  WHERE trip_duration >= 1.0::DOUBLE AND trip_duration <= 180.0::DOUBLE
    AND average_velocity >= 0.033::DOUBLE AND average_velocity <= 1.33::DOUBLE AND trip_distance > 0.0::DOUBLE
)"""
_CONSOLIDATED = """consolidated AS (
  SELECT * FROM guarded WHERE pickup_avg_median_volume IS NOT NULL AND dropoff_avg_median_volume IS NOT NULL
)"""
_SENSOR_STAGES = [_SENSORS_PARSED, _SENSORS_CLEAN, _SENSOR_PROFILE, _ZONE_PROFILE]
_FEATURE_STAGES = [_CLEAN, *_SENSOR_STAGES, _ZONED, _PROFILED, _ENRICHED, _GUARDED, _CONSOLIDATED]


def _trip_sql(body: str, upto: str = "consolidated") -> str:
    """SQL over the trip feature stages up to (and including) ``upto``."""
    names = ["clean", "sensors_parsed", "sensors_clean", "sensor_profile", "zone_profile", "zoned", "profiled",
             "enriched", "guarded", "consolidated"]
    stages = _FEATURE_STAGES[: names.index(upto) + 1]
    return with_views(body, "trips", "zones", "sensors", extra_ctes=stages)


def _sensor_sql(body: str, upto: str = "sensors_clean") -> str:
    names = ["sensors_parsed", "sensors_clean", "sensor_profile", "zone_profile"]
    return with_views(body, "sensors", extra_ctes=_SENSOR_STAGES[: names.index(upto) + 1])


# Recommendation stages: an independent formulation with a range join to the
# bounds (the Spark side uses segments + expansion).
_CUM = """cum AS (
  SELECT b.iteration, r.user_id, r.item_id, r.rating, r.ts
  FROM ratings r JOIN bounds b ON r.ts >= b.lo AND (b.hi IS NULL OR r.ts < b.hi)
)"""
_USER_COUNTS = """uc AS (SELECT iteration, user_id, CAST(count(*) AS BIGINT) AS n_ratings FROM cum GROUP BY iteration, user_id)"""
_TOP_USERS = """thr AS (SELECT iteration, quantile_cont(n_ratings, 0.95) AS threshold FROM uc GROUP BY iteration),
top_users AS (SELECT uc.iteration, uc.user_id, uc.n_ratings, thr.threshold FROM uc JOIN thr USING (iteration)
              WHERE uc.n_ratings >= thr.threshold)"""
_PICKED = """picked AS (
  SELECT iteration, arg_min(user_id, md5('42:' || CAST(user_id AS VARCHAR))) AS user_id FROM top_users GROUP BY iteration
)"""
_SAMPLED = """iu AS (SELECT DISTINCT iteration, user_id FROM cum),
sampled AS (
  SELECT iteration, user_id FROM (
    SELECT iteration, user_id,
           row_number() OVER (PARTITION BY iteration
                              ORDER BY md5(CAST(42 + iteration AS VARCHAR) || ':' || CAST(user_id AS VARCHAR)), user_id) AS rn,
           count(*) OVER (PARTITION BY iteration) AS n
    FROM iu) WHERE rn <= greatest(1, floor(n * 0.3))
)"""
_TASTE = """liked AS (
  SELECT c.iteration, c.user_id, v.embedding FROM cum c JOIN vectors v ON c.item_id = v.item_id WHERE c.rating >= 4
),
liked_el AS (
  SELECT iteration, user_id, generate_subscripts(embedding, 1) AS dim, unnest(embedding) AS x FROM liked
),
mean_el AS (
  SELECT iteration, user_id, dim, avg(CAST(x AS DOUBLE)) AS mx, CAST(count(*) AS BIGINT) AS n_vectors
  FROM liked_el GROUP BY iteration, user_id, dim
),
norms AS (SELECT iteration, user_id, sqrt(sum(mx * mx)) AS norm FROM mean_el GROUP BY iteration, user_id),
taste AS (
  SELECT m.iteration, m.user_id, m.dim, m.n_vectors,
         CASE WHEN n.norm > 0 THEN m.mx / n.norm ELSE m.mx END AS value
  FROM mean_el m JOIN norms n USING (iteration, user_id)
)"""
_SCORES = """picked_vec AS (
  SELECT t.iteration, t.user_id, list(t.value ORDER BY t.dim) AS user_vec
  FROM taste t JOIN picked p USING (iteration, user_id) GROUP BY t.iteration, t.user_id
),
scores AS (
  SELECT pv.iteration, pv.user_id, v.item_id,
         list_cosine_similarity(pv.user_vec, CAST(v.embedding AS DOUBLE[])) AS sim
  FROM picked_vec pv, vectors v
),
seen AS (SELECT DISTINCT c.iteration, c.user_id, c.item_id FROM cum c JOIN picked p USING (iteration, user_id)),
top5 AS (
  SELECT * FROM (
    SELECT s.*, row_number() OVER (PARTITION BY s.iteration, s.user_id ORDER BY s.sim DESC, s.item_id) AS rank
    FROM scores s WHERE NOT EXISTS (
      SELECT 1 FROM seen x WHERE x.iteration = s.iteration AND x.user_id = s.user_id AND x.item_id = s.item_id)
  ) WHERE rank <= 5
)"""
_POPULAR = """pop AS (
  SELECT iteration, item_id, CAST(count(*) AS BIGINT) AS n_ratings FROM cum
  WHERE item_id IN (SELECT item_id FROM movies) GROUP BY iteration, item_id
),
cold AS (
  SELECT * FROM (
    SELECT p.*, row_number() OVER (PARTITION BY iteration ORDER BY n_ratings DESC, item_id) AS rank FROM pop p
  ) WHERE rank <= 5
)"""


def _rec_sql(body: str, *stages: str) -> str:
    return with_views(body, "ratings", "movies", "vectors", "bounds", extra_ctes=[_CUM, *stages])


# --------------------------------------------------------------------- catalogue
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir, _fn=fn: _fn(Inputs(spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return deco


# ---- quality / ingest (A16, D1, D2, D3, D10, D11, D24) -----------------------
_DUCK_TYPES = ("CASE WHEN data_type = 'BIGINT' THEN 'bigint' WHEN data_type = 'INTEGER' THEN 'int' "
               "WHEN data_type = 'DOUBLE' THEN 'double' WHEN data_type = 'VARCHAR' THEN 'string' "
               "WHEN data_type LIKE 'TIMESTAMP%' AND data_type NOT LIKE '%TIME ZONE%' THEN 'timestamp_ntz' "
               "ELSE lower(data_type) END")


@register("table_report_counts", f"""
SELECT DISTINCT column_name, {_DUCK_TYPES} AS data_type, CAST(ordinal_position AS INTEGER) AS ordinal_position,
       (SELECT CAST(count(*) AS BIGINT) FROM lineitem) AS row_count
FROM information_schema.columns WHERE table_name = 'lineitem'
""")
def _table_report(i: Inputs) -> DataFrame:
    return quality.table_report(testdata.table(i.spark, i.sf_dir, "lineitem"))


_TRIP_COLS_OUT = ["trip_id", "PULocationID", "DOLocationID", "passenger_count", "trip_distance", "fare_amount",
                  "RatecodeID", "store_and_fwd_flag", "congestion_surcharge", "Airport_fee", "payment_type"]
_VALID_WHERE = ("fare_amount > 0 AND fare_amount <= 800 AND trip_distance > 0 AND trip_distance <= 100 "
                "AND passenger_count IS NOT NULL AND passenger_count > 0")


@register("clean_trips_valid", with_views(f"SELECT {', '.join(_TRIP_COLS_OUT)} FROM trips WHERE {_VALID_WHERE}", "trips"))
def _clean_valid(i: Inputs) -> DataFrame:
    return cleaning.filter_valid(i.trips).select(*_TRIP_COLS_OUT)


@register("clean_trips_imputed", with_views(f"SELECT {', '.join(_TRIP_COLS_OUT)} FROM clean", "trips", extra_ctes=[_CLEAN]))
def _clean_imputed(i: Inputs) -> DataFrame:
    return i.clean.select(*_TRIP_COLS_OUT)


@register("rows_removed_by_cleaning", with_views(f"""
SELECT CAST(count(*) AS BIGINT) AS rows_before, CAST(count_if({_VALID_WHERE}) AS BIGINT) AS rows_after,
       CAST(count(*) - count_if({_VALID_WHERE}) AS BIGINT) AS rows_removed FROM trips""", "trips"))
def _rows_removed(i: Inputs) -> DataFrame:
    return jobs.cleaning_counts(i.trips)


_TRIP_ALL = ["trip_id", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID",
             "passenger_count", "trip_distance", "RatecodeID", "store_and_fwd_flag", "payment_type", "fare_amount",
             "extra", "mta_tax", "tolls_amount", "total_amount", "congestion_surcharge", "Airport_fee",
             "cbd_congestion_fee"]


@register("null_counts_trips", with_views(
    "SELECT " + ", ".join(f"CAST(count_if({c} IS NULL) AS BIGINT) AS {c}" for c in _TRIP_ALL) + " FROM trips", "trips"))
def _null_counts(i: Inputs) -> DataFrame:
    return quality.null_counts(i.trips)


@register("rule_violations_trips", with_views("""
SELECT CAST(count_if(fare_amount <= 0) AS BIGINT) AS nonpositive_fare,
       CAST(count_if(trip_distance <= 0) AS BIGINT) AS nonpositive_distance,
       CAST(count_if(passenger_count = 0) AS BIGINT) AS zero_passengers,
       CAST(count_if(fare_amount > 500) AS BIGINT) AS fare_over_500,
       CAST(count_if(trip_distance > 100) AS BIGINT) AS distance_over_100
FROM trips""", "trips"))
def _rules_trips(i: Inputs) -> DataFrame:
    return quality.rule_counts(i.trips, jobs.trip_rules())


@register("rule_violations_sensors", with_views("""
SELECT CAST(count_if(Vol IS NOT NULL AND v IS NULL) AS BIGINT) AS unparseable_volume,
       CAST(count_if(v < 0) AS BIGINT) AS negative_volume,
       CAST(count_if(v = 0) AS BIGINT) AS zero_volume,
       CAST(count_if(v = 999) AS BIGINT) AS sentinel_999
FROM (SELECT Vol, TRY_CAST(regexp_replace(Vol, ',', '', 'g') AS INTEGER) AS v FROM sensors)""", "sensors"))
def _rules_sensors(i: Inputs) -> DataFrame:
    return quality.rule_counts(i.sensors, jobs.sensor_rules())


def _describe_sql(src: str, cols: list[str], stats: list[str], digits: int = 6) -> str:
    fn = {"count": "CAST(count({c}) AS DOUBLE)", "mean": "avg({c})", "stddev": "stddev_samp({c})",
          "min": "CAST(min({c}) AS DOUBLE)", "max": "CAST(max({c}) AS DOUBLE)"}
    parts = []
    for st in stats:
        sel = ", ".join(f"round({fn[st].format(c=c)}, {digits}) AS {c}" for c in cols)
        parts.append(f"SELECT '{st}' AS statistic, {sel} FROM {src}")
    return "\nUNION ALL\n".join(parts)


_DESCRIBE_COLS = ["fare_amount", "trip_distance", "passenger_count", "total_amount"]
_DESCRIBE_STATS = ["count", "mean", "stddev", "min", "max"]


@register("describe_trips", with_views(_describe_sql("trips", _DESCRIBE_COLS, _DESCRIBE_STATS), "trips"))
def _describe_trips(i: Inputs) -> DataFrame:
    return quality.describe(i.trips, _DESCRIBE_COLS, _DESCRIBE_STATS, digits=6)


_SUMMARY_COLS = ["trip_duration", "average_velocity", "traffic_distance_interaction"]
_SUMMARY_STATS = ["mean", "min", "max"]


@register("summary_features", _trip_sql(_describe_sql("consolidated", _SUMMARY_COLS, _SUMMARY_STATS)))
def _summary_features(i: Inputs) -> DataFrame:
    return quality.describe(i.consolidated, _SUMMARY_COLS, _SUMMARY_STATS, digits=6)


_SENSOR_ALL = ["SegmentID", "Boro", "street", "Yr", "M", "D", "HH", "MM", "Vol"]


@register("null_counts_sensors", with_views(
    "SELECT " + ", ".join(f"CAST(count_if({c} IS NULL) AS BIGINT) AS {c}" for c in _SENSOR_ALL) + " FROM sensors",
    "sensors"))
def _null_counts_sensors(i: Inputs) -> DataFrame:
    return quality.null_counts(i.sensors)


_FEATURE_NULL_COLS = ["pickup_boro", "dropoff_boro", "pickup_avg_median_volume", "dropoff_avg_median_volume",
                      "trip_duration", "average_velocity", "traffic_distance_interaction"]


@register("null_counts_features", _trip_sql(
    "SELECT " + ", ".join(f"CAST(count_if({c} IS NULL) AS BIGINT) AS {c}" for c in _FEATURE_NULL_COLS)
    + " FROM guarded", "guarded"))
def _null_counts_features(i: Inputs) -> DataFrame:
    return quality.null_counts(jobs.apply_guardrails(i.enriched), _FEATURE_NULL_COLS)


@register("summary_features_prefilter", _trip_sql(_describe_sql("enriched", _SUMMARY_COLS, _SUMMARY_STATS), "enriched"))
def _summary_prefilter(i: Inputs) -> DataFrame:
    return quality.describe(i.enriched, _SUMMARY_COLS, _SUMMARY_STATS, digits=6)


@register("rows_removed_unmapped", _trip_sql("""
SELECT CAST(count(*) AS BIGINT) AS rows_before,
       CAST(count_if(pickup_avg_median_volume IS NOT NULL AND dropoff_avg_median_volume IS NOT NULL) AS BIGINT) AS rows_after,
       CAST(count_if(pickup_avg_median_volume IS NULL OR dropoff_avg_median_volume IS NULL) AS BIGINT) AS rows_removed
FROM guarded""", "guarded"))
def _rows_removed_unmapped(i: Inputs) -> DataFrame:
    keep = F.col("pickup_avg_median_volume").isNotNull() & F.col("dropoff_avg_median_volume").isNotNull()
    return quality.rows_removed(jobs.apply_guardrails(i.enriched), keep)


@register("hour_bin_frequency", _trip_sql(
    "SELECT Hour_Bin, CAST(count(*) AS BIGINT) AS n_rows FROM consolidated GROUP BY Hour_Bin"))
def _hour_bin_frequency(i: Inputs) -> DataFrame:
    return quality.frequency(i.consolidated, "Hour_Bin", alias="n_rows")


@register("weekend_frequency", _trip_sql(
    "SELECT Is_Weekend, CAST(count(*) AS BIGINT) AS n_rows FROM consolidated GROUP BY Is_Weekend"))
def _weekend_frequency(i: Inputs) -> DataFrame:
    return quality.frequency(i.consolidated, "Is_Weekend", order="key", alias="n_rows")


# The inspection job's wish list (its capitalisation differs from
# the real column names; matching is case-insensitive) and name fragments.
_INSPECT_NAMES = ["fare_amount", "trip_distance", "trip_duration", "Average_velocity", "Traffic_distance_interaction"]
_INSPECT_FRAGMENTS = ["traffic", "volume"]
_INSPECT_MATCHED = ["fare_amount", "trip_distance", "trip_duration", "average_velocity", "traffic_distance_interaction"]
_TRAFFIC_MATCHED = ["pickup_avg_median_volume", "pickup_max_volume", "pickup_volume_stddev",
                    "dropoff_avg_median_volume", "dropoff_max_volume", "traffic_distance_interaction"]


@register("describe_features", _trip_sql(_describe_sql("consolidated", _INSPECT_MATCHED, _DESCRIBE_STATS)))
def _describe_features(i: Inputs) -> DataFrame:
    cols = quality.columns_matching(i.consolidated, names=_INSPECT_NAMES)
    return quality.describe(i.consolidated, cols, _DESCRIBE_STATS, digits=6)


@register("null_counts_traffic_columns", _trip_sql(
    "SELECT " + ", ".join(f"CAST(count_if({c} IS NULL) AS BIGINT) AS {c}" for c in _TRAFFIC_MATCHED)
    + " FROM consolidated"))
def _null_counts_traffic(i: Inputs) -> DataFrame:
    cols = quality.columns_matching(i.consolidated, contains=_INSPECT_FRAGMENTS)
    return quality.null_counts(i.consolidated, cols)


# ---- sensors (B5–B7, H1–H6, D4, D5, D12–D15, F6) ------------------------------
@register("malformed_volume", with_views(
    r"SELECT CAST(count_if(NOT regexp_full_match(Vol, '-?\d+')) AS BIGINT) AS malformed_rows FROM sensors", "sensors"))
def _malformed(i: Inputs) -> DataFrame:
    return i.sensors.agg(F.count_if(malformed_numeric("Vol")).alias("malformed_rows"))


@register("sensor_parse_sentinel", _sensor_sql(
    "SELECT SegmentID, Boro, street, Vol, Vol_numeric FROM sensors_parsed", "sensors_parsed"))
def _parse_sentinel(i: Inputs) -> DataFrame:
    return jobs.parse_sensor_volumes(i.sensors).select("SegmentID", "Boro", "street", "Vol", "Vol_numeric")


@register("sensor_timestamp_assembly", _sensor_sql("""
SELECT SegmentID, Yr, M, D, HH, MM, strftime(traffic_timestamp, '%Y-%m-%d %H:%M:%S') AS traffic_time, day_of_week
FROM sensors_clean"""))
def _timestamp_assembly(i: Inputs) -> DataFrame:
    c = jobs.clean_sensors(i.sensors)
    return c.select("SegmentID", "Yr", "M", "D", "HH", "MM",
                    F.date_format("traffic_timestamp", "yyyy-MM-dd HH:mm:ss").alias("traffic_time"), "day_of_week")


@register("describe_sensor_volume", _sensor_sql(
    _describe_sql("(SELECT TRY_CAST(regexp_replace(Vol, ',', '', 'g') AS INTEGER) AS volume FROM sensors)",
                  ["volume"], _DESCRIBE_STATS), "sensors_parsed"))
def _describe_volume(i: Inputs) -> DataFrame:
    from urbanlens.functions import parse_int

    return quality.describe(i.sensors.select(parse_int("Vol").alias("volume")), ["volume"], _DESCRIBE_STATS, digits=6)


@register("sensor_frequency_by_zone", with_views(
    "SELECT Boro, CAST(count(*) AS BIGINT) AS n_rows FROM sensors GROUP BY Boro", "sensors"))
def _freq_zone(i: Inputs) -> DataFrame:
    return quality.frequency(i.sensors, "Boro", alias="n_rows")


@register("zero_volume_by_hour", with_views(
    "SELECT HH, CAST(count(*) AS BIGINT) AS n_rows FROM sensors WHERE Vol = '0' GROUP BY HH", "sensors"))
def _zero_by_hour(i: Inputs) -> DataFrame:
    return quality.frequency(i.sensors.filter(F.col("Vol") == "0"), "HH", order="key", alias="n_rows")


@register("records_per_year", with_views(
    "SELECT Yr, CAST(count(*) AS BIGINT) AS n_rows FROM sensors GROUP BY Yr", "sensors"))
def _per_year(i: Inputs) -> DataFrame:
    return quality.frequency(i.sensors, "Yr", order="key", alias="n_rows")


@register("distinct_segments", with_views(
    "SELECT CAST(count(DISTINCT SegmentID) AS BIGINT) AS n_distinct FROM sensors", "sensors"))
def _distinct_segments(i: Inputs) -> DataFrame:
    return quality.count_distinct(i.sensors, ["SegmentID"])


@register("segment_coverage", with_views("""
SELECT CAST(count(*) AS BIGINT) AS n_keys, min(n) AS min_rows,
       CAST(quantile_disc(n, 0.25) AS BIGINT) AS p25_rows, CAST(quantile_disc(n, 0.5) AS BIGINT) AS p50_rows,
       CAST(quantile_disc(n, 0.75) AS BIGINT) AS p75_rows, max(n) AS max_rows
FROM (SELECT SegmentID, CAST(count(*) AS BIGINT) AS n FROM sensors GROUP BY SegmentID)""", "sensors"))
def _coverage(i: Inputs) -> DataFrame:
    return profile.coverage(i.sensors, "SegmentID")


@register("lowest_coverage_segments", with_views("""
SELECT SegmentID, CAST(count(*) AS BIGINT) AS n_rows FROM sensors GROUP BY SegmentID
ORDER BY n_rows, SegmentID LIMIT 5""", "sensors"))
def _lowest_coverage(i: Inputs) -> DataFrame:
    return kpi.bottom_n(profile.key_counts(i.sensors, "SegmentID"), "n_rows", 5, ["SegmentID"])


@register("sensor_median_profile", _sensor_sql("SELECT * FROM sensor_profile", "sensor_profile"))
def _median_profile(i: Inputs) -> DataFrame:
    return jobs.sensor_profile(i.sensors)


# The quantile sketch is exact for groups smaller than its accuracy (10,000 rows),
# which holds for every group of the checked data: the exact SQL median applies.
@register("sensor_median_profile_approx", _sensor_sql("SELECT * FROM sensor_profile", "sensor_profile"))
def _median_profile_approx(i: Inputs) -> DataFrame:
    return jobs.sensor_profile(i.sensors, method="approx")


@register("zone_profile", _sensor_sql("SELECT * FROM zone_profile", "zone_profile"))
def _zone_profile(i: Inputs) -> DataFrame:
    return i.zprofile


# ---- consolidation (C1–C4, C10, B8, B12, B13, B14, H6–H10, B18, B19) ----------
_ZONE_OUT = ["trip_id", "PULocationID", "DOLocationID", "pickup_boro", "dropoff_boro", "pickup_hour",
             "pickup_day_of_week"]


@register("zone_lookup_both_ends", _trip_sql(f"SELECT {', '.join(_ZONE_OUT)} FROM zoned", "zoned"))
def _zone_lookup(i: Inputs) -> DataFrame:
    return i.zoned.select(*_ZONE_OUT)


@register("cross_zone_trips", _trip_sql(
    f"SELECT {', '.join(_ZONE_OUT)} FROM zoned WHERE pickup_boro <> dropoff_boro", "zoned"))
def _cross_zone(i: Inputs) -> DataFrame:
    return enrich.filter_cross_zone(i.zoned).select(*_ZONE_OUT)


_PU_OUT = ["trip_id", "pickup_boro", "pickup_day_of_week", "pickup_hour", "pickup_avg_median_volume",
           "pickup_max_volume", "pickup_volume_stddev"]
_DO_OUT = ["trip_id", "dropoff_boro", "pickup_day_of_week", "pickup_hour", "dropoff_avg_median_volume",
           "dropoff_max_volume"]


@register("attach_profile_pickup", _trip_sql(f"SELECT {', '.join(_PU_OUT)} FROM profiled", "profiled"))
def _profile_pickup(i: Inputs) -> DataFrame:
    return i.profiled.select(*_PU_OUT)


@register("attach_profile_dropoff", _trip_sql(f"SELECT {', '.join(_DO_OUT)} FROM profiled", "profiled"))
def _profile_dropoff(i: Inputs) -> DataFrame:
    return i.profiled.select(*_DO_OUT)


_AUDIT_COLS = ["pickup_boro", "dropoff_boro", "pickup_avg_median_volume", "dropoff_avg_median_volume"]


@register("join_audit", _trip_sql("SELECT 'rows_before' AS metric, CAST(count(*) AS BIGINT) AS value FROM clean\n"
                                  "UNION ALL SELECT 'rows_after', CAST(count(*) AS BIGINT) FROM profiled\n" + "\n".join(
    f"UNION ALL SELECT 'unmatched_{c}', CAST(count_if({c} IS NULL) AS BIGINT) FROM profiled" for c in _AUDIT_COLS),
    "profiled"))
def _join_audit(i: Inputs) -> DataFrame:
    return enrich.join_audit(i.clean, i.profiled, _AUDIT_COLS)


_TEMPORAL_OUT = ["trip_id", "pickup_hour", "pickup_day_of_week", "Is_Weekend", "Hour_Bin"]
_DYNAMICS_OUT = ["trip_id", "trip_distance", "trip_duration", "average_velocity", "traffic_distance_interaction"]


@register("temporal_features", _trip_sql(f"SELECT {', '.join(_TEMPORAL_OUT)} FROM enriched", "enriched"))
def _temporal(i: Inputs) -> DataFrame:
    return i.enriched.select(*_TEMPORAL_OUT)


@register("trip_dynamics", _trip_sql(f"SELECT {', '.join(_DYNAMICS_OUT)} FROM enriched", "enriched"))
def _dynamics(i: Inputs) -> DataFrame:
    return i.enriched.select(*_DYNAMICS_OUT)


@register("guardrails", _trip_sql(f"SELECT {', '.join(_DYNAMICS_OUT)} FROM guarded", "guarded"))
def _guardrails(i: Inputs) -> DataFrame:
    return jobs.apply_guardrails(i.enriched).select(*_DYNAMICS_OUT)


_CONSOLIDATED_OUT = ["trip_id", "PULocationID", "DOLocationID", "pickup_boro", "dropoff_boro", "pickup_hour",
                     "pickup_day_of_week", "Is_Weekend", "Hour_Bin", "fare_amount", "trip_distance",
                     "trip_duration", "average_velocity", "pickup_avg_median_volume", "pickup_max_volume",
                     "pickup_volume_stddev", "dropoff_avg_median_volume", "dropoff_max_volume",
                     "traffic_distance_interaction"]


@register("drop_unmapped", _trip_sql(f"SELECT {', '.join(_CONSOLIDATED_OUT)} FROM consolidated"))
def _drop_unmapped(i: Inputs) -> DataFrame:
    return i.consolidated.select(*_CONSOLIDATED_OUT)


_MODEL_COLS = ["trip_id", "average_velocity", *model.NUMERIC_FEATURES, *model.CATEGORICAL_FEATURES, model.TARGET]
_MODEL_REQUIRED = [*model.NUMERIC_FEATURES, *model.CATEGORICAL_FEATURES, model.TARGET]


@register("complete_cases", _trip_sql(
    f"SELECT {', '.join(_MODEL_COLS)} FROM consolidated WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in _MODEL_REQUIRED)))
def _complete_cases(i: Inputs) -> DataFrame:
    return model.model_frame(i.consolidated)


# ---- KPI report (D6–D9, D22, D23, B10, B20, F1, F2) ---------------------------
def _kpi_sql(keys: list[str], metrics, src: str = "consolidated", count_alias: str = "trip_count") -> str:
    sel = ", ".join(f"round(avg({c}), {d}) AS {n}" for n, c, d in metrics)
    k = ", ".join(keys)
    return f"SELECT {k}, CAST(count(*) AS BIGINT) AS {count_alias}, {sel} FROM {src} GROUP BY {k}"


_PERIOD = "CASE WHEN Hour_Bin IN ('Morning_Rush', 'Evening_Rush') THEN 'Peak' ELSE 'Off_Peak' END"
_WITH_PERIOD = f"(SELECT *, {_PERIOD} AS period FROM consolidated)"


@register("kpi_by_hour_bin", _trip_sql(_kpi_sql(["Hour_Bin"], kpi.HOUR_BIN_METRICS)))
def _kpi_hour_bin(i: Inputs) -> DataFrame:
    return jobs.kpi_by_hour_bin(i.consolidated)


@register("kpi_by_zone", _trip_sql(_kpi_sql(["pickup_boro"], kpi.ZONE_METRICS)))
def _kpi_zone(i: Inputs) -> DataFrame:
    return jobs.kpi_by_zone(i.consolidated)


@register("kpi_by_zone_period", _trip_sql(_kpi_sql(["pickup_boro", "period"], kpi.ZONE_PERIOD_METRICS, _WITH_PERIOD)))
def _kpi_zone_period(i: Inputs) -> DataFrame:
    return jobs.kpi_by_zone_period(i.consolidated)


@register("correlations_with_fare", _trip_sql("SELECT " + ", ".join(
    f"round(corr(fare_amount, {c}), 6) AS {n}" for n, c in kpi.FARE_CORRELATES.items()) + " FROM consolidated"))
def _correlations(i: Inputs) -> DataFrame:
    return kpi.correlations(i.consolidated)


@register("peak_offpeak_pivot", _trip_sql(f"""
SELECT pickup_boro, max(CASE WHEN period = 'Peak' THEN avg_fare END) AS Peak,
       max(CASE WHEN period = 'Off_Peak' THEN avg_fare END) AS Off_Peak
FROM (SELECT pickup_boro, period, round(avg(fare_amount), 2) AS avg_fare FROM {_WITH_PERIOD} GROUP BY pickup_boro, period)
GROUP BY pickup_boro"""))
def _peak_pivot(i: Inputs) -> DataFrame:
    return jobs.peak_offpeak_by_zone(i.consolidated)


@register("hour_bin_report_order", _trip_sql(f"""
SELECT o.Hour_Bin, o.report_order, k.* EXCLUDE (Hour_Bin)
FROM (VALUES ('Morning_Rush', 1), ('Off_Peak_Day', 2), ('Evening_Rush', 3), ('Late_Night_Off_Peak', 4))
     AS o(Hour_Bin, report_order)
LEFT JOIN ({_kpi_sql(["Hour_Bin"], kpi.HOUR_BIN_METRICS)}) k ON o.Hour_Bin = k.Hour_Bin"""))
def _hour_bin_order(i: Inputs) -> DataFrame:
    return jobs.hour_bin_report(i.spark, i.consolidated)


# ---- model (K1, J1–J8, D16, D17, F7) ------------------------------------------
_THRESH = hash_threshold(SPLIT_FRACTION)


@register("hash_split_counts", _trip_sql(f"""
SELECT CASE WHEN substr(md5('{SEED}:' || CAST(trip_id AS VARCHAR)), 1, 8) < '{_THRESH}' THEN 'train' ELSE 'test' END AS split,
       CAST(count(*) AS BIGINT) AS n_rows
FROM consolidated WHERE {" AND ".join(f"{c} IS NOT NULL" for c in _MODEL_REQUIRED)} GROUP BY split"""))
def _hash_split(i: Inputs) -> DataFrame:
    split = hash_split_label(["trip_id"], SPLIT_FRACTION, SEED)
    return model.model_frame(i.consolidated).groupBy(split.alias("split")).agg(F.count(F.lit(1)).alias("n_rows"))


# The forest is fitted once for its input files and parameters and stored; the queries read it.
def _stored_model(i: Inputs) -> str:
    inputs = {t: os.path.join(i.sf_dir, f"{t}.parquet") for t in ("lineitem", "orders", "customer", "supplier", "nation", "region", "events")}
    return jobs.stored_fare_model(i.spark, lambda: i.consolidated, f"{checkpoint_dir(i.spark)}/fare-model", inputs)


def _scored(i: Inputs) -> DataFrame:
    return i.spark.read.parquet(f"{_stored_model(i)}/predictions")


@register("fare_model_metrics")
def _model_metrics(i: Inputs) -> DataFrame:
    return model.evaluate(_scored(i))


@register("fare_model_importance")
def _model_importance(i: Inputs) -> DataFrame:
    return model.importance_table(i.spark, PipelineModel.load(f"{_stored_model(i)}/model"))


@register("scored_by_hour_bin")
def _scored_hour_bin(i: Inputs) -> DataFrame:
    return kpi.kpi(_scored(i), ["Hour_Bin"], kpi.SCORED_HOUR_BIN_METRICS, "num_trips", [F.desc("avg_pickup_traffic_vol")])


@register("scored_by_zone")
def _scored_zone(i: Inputs) -> DataFrame:
    return kpi.kpi(_scored(i), ["pickup_boro"], kpi.SCORED_ZONE_METRICS, "num_trips", [F.desc("avg_traffic_vol")])


# ---- recommendations
@register("cumulative_ratings", _rec_sql("""
SELECT iteration, CAST(count(*) AS BIGINT) AS n_ratings, CAST(count(DISTINCT user_id) AS BIGINT) AS n_users,
       CAST(count(DISTINCT item_id) AS BIGINT) AS n_items, min(ts) AS first_ts, max(ts) AS last_ts
FROM cum GROUP BY iteration"""))
def _cumulative(i: Inputs) -> DataFrame:
    return recsys.slice_summary(i.ratings, i.slices).select(
        "iteration", "n_ratings", "n_users", "n_items", "first_ts", "last_ts")


@register("new_users_per_iteration", _rec_sql("""
SELECT DISTINCT c.iteration, c.user_id FROM cum c
WHERE NOT EXISTS (SELECT 1 FROM cum p WHERE p.iteration = c.iteration - 1 AND p.user_id = c.user_id)"""))
def _new_users(i: Inputs) -> DataFrame:
    return recsys.new_keys(i.ratings, i.slices, "user_id")


@register("item_popularity_topn", _rec_sql("""
SELECT c.iteration, CAST(c.rank AS INTEGER) AS rank, c.item_id, m.title, c.n_ratings
FROM cold c JOIN movies m USING (item_id)""", _POPULAR))
def _popularity(i: Inputs) -> DataFrame:
    return recsys.cold_recommendations(i.ratings, i.movies, i.slices)


@register("top_users_p95", _rec_sql(
    "SELECT iteration, user_id, n_ratings, round(threshold, 6) AS threshold FROM top_users", _USER_COUNTS, _TOP_USERS))
def _top_users(i: Inputs) -> DataFrame:
    return recsys.top_users(i.ratings, i.slices).withColumn("threshold", F.round("threshold", 6))


@register("user_stats", _rec_sql("""
SELECT iteration, user_id,
       strftime(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(max(ts)), '%Y-%m-%d %H:%M:%S') AS last_interaction_time,
       CAST(count(*) AS BIGINT) AS num_ratings, CAST(format('{:.2f}', avg(rating)) AS DOUBLE) AS avg_rating
FROM cum GROUP BY iteration, user_id"""))
def _user_stats(i: Inputs) -> DataFrame:
    return recsys.user_stats(i.ratings, i.slices)


@register("sampled_users", _rec_sql("SELECT iteration, user_id FROM sampled", _SAMPLED))
def _sampled(i: Inputs) -> DataFrame:
    return recsys.sample_users(i.ratings, i.slices)


@register("picked_top_user", _rec_sql("SELECT iteration, user_id FROM picked", _USER_COUNTS, _TOP_USERS, _PICKED))
def _picked(i: Inputs) -> DataFrame:
    return recsys.pick_top_user(i.ratings, i.slices)


@register("liked_vectors", _rec_sql("""
SELECT c.iteration, c.user_id, CAST(count(*) AS BIGINT) AS n_liked,
       CAST(count(v.item_id) AS BIGINT) AS n_liked_with_vector
FROM cum c LEFT JOIN vectors v ON c.item_id = v.item_id WHERE c.rating >= 4 GROUP BY c.iteration, c.user_id"""))
def _liked(i: Inputs) -> DataFrame:
    return recsys.liked_with_vectors(i.ratings, i.vectors, i.slices)


@register("taste_vectors", _rec_sql("""
SELECT t.iteration, t.user_id, t.n_vectors, CAST(t.dim - 1 AS INTEGER) AS dim, round(t.value, 6) AS value
FROM taste t JOIN sampled s USING (iteration, user_id)""", _SAMPLED, _TASTE))
def _taste(i: Inputs) -> DataFrame:
    state = recsys.user_state(i.ratings, i.vectors, i.slices)
    return state.select("iteration", "user_id", "n_vectors", F.posexplode("embedding").alias("dim", "value")).withColumn(
        "value", F.round("value", 6))


@register("cosine_scores", _rec_sql("SELECT iteration, user_id, item_id, round(sim, 6) AS sim FROM scores",
                                    _USER_COUNTS, _TOP_USERS, _PICKED, _TASTE, _SCORES))
def _cosine(i: Inputs) -> DataFrame:
    picked = recsys.pick_top_user(i.ratings, i.slices)
    taste = recsys.taste_vectors(i.ratings, i.vectors, i.slices, users=picked)
    return recsys.score_items(taste, i.vectors, i.slices).withColumn("sim", F.round("sim", 6))


@register("recommend_top5", _rec_sql("""
SELECT t.iteration, t.user_id, CAST(t.rank AS INTEGER) AS rank, t.item_id, m.title, round(t.sim, 6) AS sim
FROM top5 t JOIN movies m USING (item_id)""", _USER_COUNTS, _TOP_USERS, _PICKED, _TASTE, _SCORES))
def _recommend(i: Inputs) -> DataFrame:
    return recsys.top_user_recommendations(i.ratings, i.vectors, i.movies, i.slices).withColumn(
        "sim", F.round("sim", 6))


@register("recommend_with_fallback", _rec_sql("""
SELECT c.iteration, 'cold' AS user_type, CAST(NULL AS BIGINT) AS user_id, CAST(c.rank AS INTEGER) AS rank,
       c.item_id, m.title
FROM cold c JOIN movies m USING (item_id)
UNION ALL
SELECT t.iteration, 'top', t.user_id, CAST(t.rank AS INTEGER), t.item_id, m.title
FROM top5 t JOIN movies m USING (item_id)
UNION ALL
SELECT c.iteration, 'top', p.user_id, CAST(c.rank AS INTEGER), c.item_id, m.title
FROM cold c JOIN movies m USING (item_id) JOIN picked p USING (iteration)
WHERE c.iteration NOT IN (SELECT iteration FROM picked_vec)""", _USER_COUNTS, _TOP_USERS, _PICKED, _TASTE, _SCORES, _POPULAR))
def _fallback(i: Inputs) -> DataFrame:
    return recsys.recommendations_with_fallback(i.ratings, i.vectors, i.movies, i.slices)


# Fixed value: result documents carry a caller-supplied generation time so that
# reruns are repeatable.
GENERATED_AT = "1970-01-01T00:00:00Z"


@register("recommendation_documents", _rec_sql(f"""
SELECT k.kind AS User_Type,
       CASE WHEN k.kind = 'top' THEN strftime(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(s.last_ts), '%Y-%m-%d %H:%M:%S') END AS Last_Interaction_Time,
       CAST(CASE WHEN k.kind = 'top' THEN s.n ELSE 0 END AS BIGINT) AS Num_Ratings,
       CASE WHEN k.kind = 'top' THEN CAST(format('{{:.2f}}', s.mean) AS DOUBLE) END AS Avg_Rating,
       coalesce((SELECT string_agg(m.title, ' | ' ORDER BY r.rank) FROM (
           SELECT 'cold' AS kind, iteration, rank, item_id FROM cold
           UNION ALL SELECT 'top', iteration, rank, item_id FROM top5
           UNION ALL SELECT 'top', iteration, rank, item_id FROM cold WHERE iteration NOT IN (SELECT iteration FROM picked_vec)
         ) r JOIN movies m USING (item_id) WHERE r.kind = k.kind AND r.iteration = p.iteration), '') AS Recommendations,
       p.iteration, '{GENERATED_AT}' AS generated_at
FROM picked p
JOIN (SELECT iteration, user_id, count(*) AS n, max(ts) AS last_ts, avg(rating) AS mean FROM cum GROUP BY ALL) s USING (iteration, user_id),
     (VALUES ('cold'), ('top')) AS k(kind)""", _USER_COUNTS, _TOP_USERS, _PICKED, _TASTE, _SCORES, _POPULAR))
def _documents(i: Inputs) -> DataFrame:
    docs = recsys.recommendation_documents(i.ratings, i.vectors, i.movies, i.slices, GENERATED_AT)
    return docs.withColumn("Recommendations", F.array_join("Recommendations", " | "))


_DIM = 64


@register("embed_text", with_views(f"""
SELECT c.item_id, c.place AS dim, round(c.w / n.norm, 6) AS value
FROM cells c JOIN (SELECT item_id, sqrt(sum(w * w)) AS norm FROM cells GROUP BY item_id) n USING (item_id)""", "movies", extra_ctes=[f"""tok AS (
  SELECT item_id, unnest(string_split_regex(lower(title || ': ' || replace(genres, '|', ' ')), '[^\\p{{L}}\\p{{N}}]+')) AS t FROM movies
),
tf AS (
  SELECT item_id, CAST(CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % {_DIM} AS INTEGER) AS place, count(*) AS tf
  FROM tok WHERE t <> '' GROUP BY ALL
),
idf AS (SELECT place, ln(((SELECT count(*) FROM movies) + 1) / (count(*) + 1)) + 1 AS idf FROM tf GROUP BY place),
cells AS (SELECT tf.item_id, tf.place, tf.tf * idf.idf AS w FROM tf JOIN idf USING (place))"""]))
def _embed_text(i: Inputs) -> DataFrame:
    found = text.embed_text(text.with_item_text(i.movies), dim=_DIM)
    return found.select("item_id", F.posexplode("embedding").alias("dim", "value")).where("value <> 0").withColumn("value", F.round("value", 6))


# ---- deterministic parts of the fare model (J1, J2, J6, D16, D17) ---------------
_FRAME = f"(SELECT * FROM consolidated WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _MODEL_REQUIRED)})"
_LINEAR = f"(SELECT *, 3.0::DOUBLE + trip_distance * 2.5::DOUBLE + trip_duration * 0.5::DOUBLE AS prediction FROM {_FRAME})"
_INDEX = "(" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category, count(*) AS n FROM {_FRAME} GROUP BY {c}" for c in model.CATEGORICAL_FEATURES) + ")"
_INDEXED = f"""(SELECT feature, category, CAST(row_number() OVER (PARTITION BY feature ORDER BY n DESC, category) - 1 AS DOUBLE) AS category_index FROM {_INDEX})"""


@register("category_index", _trip_sql(f"SELECT feature, category, category_index FROM {_INDEXED}"))
def _category_index(i: Inputs) -> DataFrame:
    return model.category_index(model.model_frame(i.consolidated))


@register("assembled_features", _trip_sql(
    "SELECT f.trip_id, " + ", ".join(f"round(CAST(f.{c} AS DOUBLE), 6) AS {c}" for c in model.NUMERIC_FEATURES) + ", "
    + ", ".join(f"i{k}.category_index AS {c}_idx" for k, c in enumerate(model.CATEGORICAL_FEATURES)) + f" FROM {_FRAME} f "
    + " ".join(f"JOIN {_INDEXED} i{k} ON i{k}.feature = '{c}' AND i{k}.category = CAST(f.{c} AS VARCHAR)" for k, c in enumerate(model.CATEGORICAL_FEATURES))))
def _assembled(i: Inputs) -> DataFrame:
    wide = model.assembled(model.model_frame(i.consolidated))
    return wide.select("trip_id", *[F.round(c, 6).alias(c) for c in model.NUMERIC_FEATURES], *[f"{c}_idx" for c in model.CATEGORICAL_FEATURES])


@register("linear_fare_metrics", _trip_sql(f"""
WITH e AS (SELECT fare_amount AS y, prediction - fare_amount AS e FROM {_LINEAR})
SELECT 'rmse' AS metric, round(sqrt(avg(e * e)), 6) AS value FROM e
UNION ALL SELECT 'r2', round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) FROM e
UNION ALL SELECT 'mae', round(avg(abs(e)), 6) FROM e""".replace("WITH e AS", "SELECT * FROM (WITH e AS") + ")"))
def _linear_metrics(i: Inputs) -> DataFrame:
    return model.evaluate(model.linear_prediction(model.model_frame(i.consolidated))).withColumn("value", F.round("value", 6))


@register("linear_scored_by_hour_bin", _trip_sql(_kpi_sql(["Hour_Bin"], kpi.SCORED_HOUR_BIN_METRICS, _LINEAR, "num_trips")))
def _linear_hour_bin(i: Inputs) -> DataFrame:
    return kpi.kpi(model.linear_prediction(model.model_frame(i.consolidated)), ["Hour_Bin"], kpi.SCORED_HOUR_BIN_METRICS, "num_trips")


@register("linear_scored_by_zone", _trip_sql(_kpi_sql(["pickup_boro"], kpi.SCORED_ZONE_METRICS, _LINEAR, "num_trips")))
def _linear_zone(i: Inputs) -> DataFrame:
    return kpi.kpi(model.linear_prediction(model.model_frame(i.consolidated)), ["pickup_boro"], kpi.SCORED_ZONE_METRICS, "num_trips")


# ---- exclusion, point lookup, sample rows (B9, B10, A16) -------------------------
_EXCLUDED_ZONE, _LEAST_TRIPS = "ASIA", 100


@register("kpi_by_zone_excluding", _trip_sql(f"""
SELECT * FROM ({_kpi_sql(["pickup_boro"], kpi.ZONE_METRICS)})
WHERE pickup_boro <> '{_EXCLUDED_ZONE}' AND trip_count >= {_LEAST_TRIPS}"""))
def _kpi_excluding(i: Inputs) -> DataFrame:
    return cleaning.exclude_values(jobs.kpi_by_zone(i.consolidated), "pickup_boro", (_EXCLUDED_ZONE,), _LEAST_TRIPS)


@register("zone_point_lookup", with_views("SELECT LocationID, Boro_Name FROM zones WHERE LocationID = 7", "zones"))
def _point_lookup(i: Inputs) -> DataFrame:
    return i.zones.where(F.col("LocationID") == 7)


@register("trip_sample_rows", with_views(
    "SELECT trip_id, PULocationID, DOLocationID, trip_distance FROM trips ORDER BY trip_id, PULocationID, DOLocationID, trip_distance LIMIT 5", "trips"))
def _sample_rows(i: Inputs) -> DataFrame:
    names = ["trip_id", "PULocationID", "DOLocationID", "trip_distance"]
    return quality.sample_rows(i.trips.select(*names), names)


from urbanlens.plans import queries_models, queries_sources, queries_state  # noqa: E402,F401  (they register more queries)
