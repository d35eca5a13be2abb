"""Job entry points: read inputs, run one composite plan, write its outputs.

Each ``run_*`` function corresponds to one step of the surveyed workflow
(clean trips, sensor profile, consolidation, KPI report, fare model, quality
report, chart tables, item vectors, user state, recommendations). Paths are
arguments; nothing is hard-coded. ``python -m urbanlens.plans.run <job> ...``
exposes the same functions on the command line.
"""

from __future__ import annotations

import argparse
import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from urbanlens.functions import malformed_numeric, nullify_sentinels, parse_int
from urbanlens.operators import cleaning, enrich, kpi, profile, quality, recsys, state, text
from urbanlens.operators.inspection import inspect
from urbanlens.plans import jobs
from urbanlens.sources import drift, quarantine, readers, sinks, versions

# Cumulative slices of the recommendation workload (UTC days; the
# last one is open).
DEFAULT_SLICES = recsys.Slices(
    first_day=_dt.date(2000, 4, 25),
    last_days=(_dt.date(2000, 8, 3), _dt.date(2000, 10, 31), _dt.date(2000, 11, 26), None),
)


# ----------------------------------------------------------------------- P1
def run_clean_trips(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """Clean raw trips into ``dst``; returns the before/after counts (one row). The files of ``src`` may differ in
    their columns' types (months of many years)."""
    before, after = Observation(), Observation()
    raw = drift.read_drifting(spark, src).observe(before, F.count(F.lit(1)).alias("n"))
    sinks.write_parquet(jobs.clean_trips(raw).observe(after, F.count(F.lit(1)).alias("n")), dst)
    n, kept = before.get["n"], after.get["n"]  # counted while writing
    return spark.range(1).select(F.lit(n).alias("rows_before"), F.lit(kept).alias("rows_after"), F.lit(n - kept).alias("rows_removed"))


# ----------------------------------------------------------------------- P2
def run_sensor_profile(spark: SparkSession, csv_path: str, dst: str, method: str = "exact", quarantine_dst: str | None = None) -> None:
    """Median profile of the sensor counts; with ``quarantine_dst`` rows that do not fit the schema are kept there
    and take no part."""
    if quarantine_dst:
        raw = quarantine.load(spark, csv_path, readers.SENSOR_COUNTS_SCHEMA, quarantine_dst).good
    else:
        raw = readers.read_csv(spark, csv_path, readers.SENSOR_COUNTS_SCHEMA)
    sinks.write_parquet(jobs.sensor_profile(raw, method), dst)


# ----------------------------------------------------------------------- P3
def run_consolidate(
    spark: SparkSession,
    clean_trips_dir: str,
    sensor_profile_dir: str,
    lookup_csv: str,
    dst: str,
    audit_dst: str | None = None,
) -> None:
    """Feature table from cleaned trips, the sensor profile and the zone lookup."""
    trips = readers.read_parquet(spark, clean_trips_dir)
    zprofile = profile.rollup_profile(readers.read_parquet(spark, sensor_profile_dir))
    zones = readers.read_lookup(spark, lookup_csv)
    enrich.assert_unique(zones, ["LocationID"])  # a duplicated key would add trips
    before, after = Observation(), Observation()
    joined = ["pickup_boro", "dropoff_boro", *jobs.PROFILE_REQUIRED]
    counted = trips.observe(before, F.count(F.lit(1)).alias("n"))
    enriched = jobs.enrich_trips(counted, zones, zprofile).observe(
        after, F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in joined])
    sinks.write_parquet(jobs.apply_guardrails(enriched).dropna(subset=list(jobs.PROFILE_REQUIRED)), dst)
    if audit_dst:  # counted while writing: the joins run once
        rows = [("rows_before", before.get["n"]), ("rows_after", after.get["n"]), *((f"unmatched_{c}", after.get[c]) for c in joined)]
        sinks.write_report_csv(spark.createDataFrame(rows, "metric string, value bigint"), audit_dst)


# ----------------------------------------------------------------------- P4
def run_congestion_report(spark: SparkSession, features_dir: str, out_dir: str) -> None:
    """Three KPI tables and the correlation row, from one scan of the pruned columns."""
    features = readers.read_parquet(spark, features_dir).select(*jobs.REPORT_COLUMNS)
    jobs.congestion_report(features).write(out_dir)


# ----------------------------------------------------------------------- P5
def run_fare_model(
    spark: SparkSession, features_dir: str, model_dir: str, report_dir: str, **forest_params
) -> None:
    fm = jobs.fare_model(spark, readers.read_parquet(spark, features_dir), **forest_params)
    sinks.save_model(fm.model, model_dir)
    for name in ("metrics", "importance", "scored_by_hour_bin", "scored_by_zone"):
        sinks.write_report_csv(getattr(fm, name), f"{report_dir}/{name}")


# ----------------------------------------------------------------------- P6
def run_quality_report(
    spark: SparkSession, trips_src: str | None, sensors_csv: str | None, out_dir: str, features_src: str | None = None
) -> None:
    """Table reports, null counts, rule violations, descriptive statistics and
    frequencies of the trips, the sensor counts and the feature table."""

    def write(df: DataFrame, name: str) -> None:
        sinks.write_report_csv(df, f"{out_dir}/{name}")

    if trips_src:
        t = drift.read_drifting(spark, trips_src)
        found = inspect(t, rules=jobs.trip_rules(), described=quality.columns_matching(t, names=jobs.DESCRIBED_TRIP_COLUMNS))
        write(found.table_report(), "trip_table")
        write(found.nulls(), "trip_nulls")
        write(found.broken_rules(), "trip_rules")
        write(found.describe(), "trip_describe")
    if sensors_csv:
        s = readers.read_csv(spark, sensors_csv, readers.SENSOR_COUNTS_SCHEMA)
        rules = {**jobs.sensor_rules(), "malformed_volume": malformed_numeric("Vol"), "zero_text": F.col("Vol") == "0"}
        volume = nullify_sentinels(parse_int("Vol"))
        found = inspect(s, ["SegmentID", "Boro", "Yr", "HH"], rules, {"Vol_numeric": volume})
        write(found.table_report(), "sensor_table")
        write(found.nulls(), "sensor_nulls")
        write(found.broken_rules().drop("zero_text"), "sensor_rules")
        write(found.describe(), "sensor_volume")
        write(found.distinct("SegmentID"), "distinct_segments")
        write(found.coverage("SegmentID"), "segment_coverage")
        write(kpi.bottom_n(found.key_counts("SegmentID"), "n_rows", 5, ["SegmentID"]), "lowest_coverage")
        write(found.frequency("Boro"), "sensor_by_zone")
        write(found.frequency("Yr", by_count=False), "records_per_year")
        write(found.frequency("HH", rule="zero_text", by_count=False), "zero_volume_by_hour")
    if features_src:
        f = readers.read_parquet(spark, features_src)
        found = inspect(f, ["Hour_Bin", "Is_Weekend"], described=quality.columns_matching(f, names=jobs.DESCRIBED_FEATURES))
        write(found.table_report(), "feature_table")
        write(found.nulls(quality.columns_matching(f, contains=["volume"])), "feature_nulls")
        write(found.describe(), "feature_describe")
        write(found.frequency("Hour_Bin"), "feature_hour_bins")
        write(found.frequency("Is_Weekend", by_count=False), "feature_weekend")


# ----------------------------------------------------------------------- P7
def run_chart_tables(
    spark: SparkSession, report_dir: str, out_dir: str, exclude: tuple[str, ...] = (), min_rows: int | None = None
) -> None:
    """The tables behind the report charts, read back from the KPI reports."""
    by_zone = readers.read_report_csv(spark, f"{report_dir}/by_zone")
    by_zone_period = readers.read_report_csv(spark, f"{report_dir}/by_zone_period")
    by_hour_bin = readers.read_report_csv(spark, f"{report_dir}/by_hour_bin")
    sinks.write_report_csv(cleaning.exclude_values(by_zone, "pickup_boro", exclude, min_rows), f"{out_dir}/fare_by_zone")
    pivot = kpi.pivot_metric(cleaning.exclude_values(by_zone_period, "pickup_boro", exclude, min_rows),
                             "pickup_boro", "period", ["Peak", "Off_Peak"], "avg_fare")
    sinks.write_report_csv(pivot, f"{out_dir}/peak_vs_offpeak")
    sinks.write_report_csv(kpi.reindex(spark, by_hour_bin, "Hour_Bin", kpi.HOUR_BIN_ORDER), f"{out_dir}/by_hour_bin")
    sinks.write_report_csv(readers.read_report_csv(spark, f"{report_dir}/correlations"), f"{out_dir}/correlations")


# ----------------------------------------------------------------------- P8
def run_item_vectors(
    spark: SparkSession, movies_path: str, vectors_dst: str, meta_dst: str, force: bool = False, dim: int = 64
) -> None:
    """Item vectors and the catalogue, built once unless ``force``."""
    movies = readers.load_movies(spark, movies_path)
    sinks.write_once(spark, lambda: text.embed_text(text.with_item_text(movies), dim=dim), vectors_dst, force)
    sinks.write_once(spark, lambda: movies, meta_dst, force)


def run_versioned_item_vectors(
    spark: SparkSession, movies_path: str, root: str, force: bool = False, dim: int = 512, rank: int = 64, latent: bool = True
) -> str:
    """Item vectors and the catalogue as a version under ``root``, built again when the catalogue's files or
    the parameters change; returns the version's folder (``vectors`` and ``catalogue``)."""

    def write(folder: str) -> None:
        movies = readers.load_movies(spark, movies_path)
        named = text.with_item_text(movies)
        sinks.write_vectors(text.latent_text(named, dim=dim, rank=rank) if latent else text.embed_text(named, dim=dim), f"{folder}/vectors")
        sinks.write_parquet(movies, f"{folder}/catalogue")

    return versions.build(spark, root, {"movies": movies_path}, write, {"dim": dim, "rank": rank, "latent": latent}, force)


# ----------------------------------------------------------------------- P9
def run_user_state(
    spark: SparkSession, ratings_path: str, vectors_dir: str, state_dir: str,
    slices: recsys.Slices = DEFAULT_SLICES,
) -> None:
    ratings = readers.load_ratings(spark, ratings_path)
    vectors = readers.read_vectors(spark, vectors_dir)
    sinks.write_state(recsys.user_state(ratings, vectors, slices), state_dir)


def run_next_iteration(
    spark: SparkSession, segments_dir: str, vectors_dir: str, sums_dir: str, iteration: int, new_ratings: str | None = None,
    slices: recsys.Slices = DEFAULT_SLICES,
) -> None:
    """Advance the stored sums of all users by one iteration, reading only its ratings. ``new_ratings`` (``::`` text), if
    given, are first put into the segments they belong to."""
    if new_ratings:
        state.write_segments(readers.load_ratings(spark, new_ratings), slices, segments_dir)
    state.advance(spark, segments_dir, readers.read_vectors(spark, vectors_dir), sums_dir, iteration)


def run_recommend_all(
    spark: SparkSession, ratings_path: str, vectors_dir: str, state_dir: str, dst: str, slices: recsys.Slices = DEFAULT_SLICES
) -> None:
    """Top items of every user with a stored vector, partitioned by iteration."""
    found = recsys.recommend_all(readers.read_state(spark, state_dir), readers.load_ratings(spark, ratings_path), readers.read_vectors(spark, vectors_dir), slices)
    sinks.write_state(found, dst)


# ---------------------------------------------------------------------- P10
def run_recommendations(
    spark: SparkSession, ratings_path: str, vectors_dir: str, catalogue_dir: str, out_dir: str,
    slices: recsys.Slices = DEFAULT_SLICES, generated_at: str | None = None, state_dir: str | None = None,
) -> None:
    """Result documents; the top user's vector comes from the stored state when
    ``state_dir`` holds it, else it is recomputed from the ratings."""
    ratings = readers.load_ratings(spark, ratings_path)
    vectors = readers.read_vectors(spark, vectors_dir)
    catalogue = readers.read_parquet(spark, catalogue_dir)
    state = readers.read_state(spark, state_dir) if state_dir else None
    # default stamp: ISO time in UTC with microseconds and a "Z" suffix
    stamp = generated_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat() + "Z"
    docs = recsys.recommendation_documents(ratings, vectors, catalogue, slices, stamp, state=state)
    sinks.write_recommendations_json(docs, out_dir)


# ---------------------------------------------------------------------- CLI
def main(argv: list[str] | None = None) -> None:
    from urbanlens.session import build_session

    p = argparse.ArgumentParser(prog="urbanlens")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("clean-trips"); a.add_argument("src"); a.add_argument("dst")
    a = sub.add_parser("sensor-profile"); a.add_argument("csv"); a.add_argument("dst"); a.add_argument("--method", default="exact")
    a = sub.add_parser("consolidate"); [a.add_argument(x) for x in ("trips", "profile", "lookup", "dst")]
    a.add_argument("--audit")
    a = sub.add_parser("congestion-report"); a.add_argument("features"); a.add_argument("out")
    a = sub.add_parser("fare-model"); [a.add_argument(x) for x in ("features", "model", "reports")]
    a = sub.add_parser("quality-report"); a.add_argument("out"); a.add_argument("--trips"); a.add_argument("--sensors"); a.add_argument("--features")
    a = sub.add_parser("chart-tables"); a.add_argument("reports"); a.add_argument("out")
    a.add_argument("--exclude", nargs="*", default=[]); a.add_argument("--min-rows", type=int)
    a = sub.add_parser("item-vectors"); [a.add_argument(x) for x in ("movies", "vectors", "meta")]
    a.add_argument("--force", action="store_true")
    a = sub.add_parser("user-state"); [a.add_argument(x) for x in ("ratings", "vectors", "state")]
    a = sub.add_parser("recommendations"); [a.add_argument(x) for x in ("ratings", "vectors", "catalogue", "out")]
    a.add_argument("--state")
    args = p.parse_args(argv)
    spark = build_session(master=None)
    if args.job == "clean-trips":
        run_clean_trips(spark, args.src, args.dst).show()
    elif args.job == "sensor-profile":
        run_sensor_profile(spark, args.csv, args.dst, args.method)
    elif args.job == "consolidate":
        run_consolidate(spark, args.trips, args.profile, args.lookup, args.dst, args.audit)
    elif args.job == "congestion-report":
        run_congestion_report(spark, args.features, args.out)
    elif args.job == "fare-model":
        run_fare_model(spark, args.features, args.model, args.reports)
    elif args.job == "quality-report":
        run_quality_report(spark, args.trips, args.sensors, args.out, args.features)
    elif args.job == "chart-tables":
        run_chart_tables(spark, args.reports, args.out, tuple(args.exclude), args.min_rows)
    elif args.job == "item-vectors":
        run_item_vectors(spark, args.movies, args.vectors, args.meta, args.force)
    elif args.job == "user-state":
        run_user_state(spark, args.ratings, args.vectors, args.state)
    elif args.job == "recommendations":
        run_recommendations(spark, args.ratings, args.vectors, args.catalogue, args.out, state_dir=args.state)


if __name__ == "__main__":
    main()
