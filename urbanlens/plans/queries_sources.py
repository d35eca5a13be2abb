"""Queries of the catalogue that write what Spark derives from the tables through the sinks and read
it back through the readers (A1–A5, A7–A15, P3, P6)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.functions import nullify_sentinels, parse_int
from urbanlens.operators import kpi, recsys
from urbanlens.operators.inspection import inspect
from urbanlens.plans import jobs
from urbanlens.plans.catalog import (
    _DESCRIBE_COLS,
    _DESCRIBE_STATS,
    _describe_sql,
    _kpi_sql,
    _rec_sql,
    _trip_sql,
    GENERATED_AT,
    Inputs,
    ORACLE_SQL,
    register,
)
from urbanlens.session import checkpoint_dir
from urbanlens.sources import drift, layout, quarantine, readers, sinks, versions
from urbanlens.sources.testdata import with_views


def _folder(i: Inputs, name: str) -> str:
    return f"{checkpoint_dir(i.spark)}/{name}-{uuid.uuid4().hex}"


# ---- drifting months (A1, A7): years with other types, a missing and a late column -------------
@register("drifting_years", with_views("""
SELECT year(tpep_pickup_datetime) AS yr, CAST(count(*) AS BIGINT) AS n_rows, round(sum(passenger_count), 6) AS passengers, round(sum(fare_amount), 2) AS fares,
       CAST(count(CASE WHEN year(tpep_pickup_datetime) >= 1996 THEN cbd_congestion_fee END) AS BIGINT) AS n_fees
FROM trips WHERE fare_amount > 300 GROUP BY yr""", "trips"))
def _drifting(i: Inputs) -> DataFrame:
    root = _folder(i, "years")
    yr = F.year("tpep_pickup_datetime")
    t = i.trips.select("tpep_pickup_datetime", "passenger_count", "fare_amount", "cbd_congestion_fee")
    old = t.where(yr < 1994).withColumn("passenger_count", F.col("passenger_count").cast("int")).drop("cbd_congestion_fee")
    middle = t.where((yr >= 1994) & (yr < 1996)).withColumnRenamed("passenger_count", "Passenger_Count").drop("cbd_congestion_fee")
    for name, df in (("old", old), ("middle", middle), ("new", t.where(yr >= 1996).withColumn("passenger_count", F.col("passenger_count").cast("bigint")))):
        sinks.write_parquet(df, f"{root}/{name}")
    found = drift.read_drifting(i.spark, root).where(F.col("fare_amount") > 300)
    return found.groupBy(yr.alias("yr")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("passenger_count"), 6).alias("passengers"), F.round(F.sum("fare_amount"), 2).alias("fares"), F.count("cbd_congestion_fee").alias("n_fees"))


# ---- CSV with rows that do not fit (A2) ---------------------------------------------------------

@register("sensor_rows_by_fault", with_views(f"""
SELECT fault, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN fault IS NULL THEN TRY_CAST(regexp_replace(Vol, ',', '', 'g') AS INTEGER) END) AS BIGINT) AS volume
FROM (SELECT Vol, CASE WHEN SegmentID % 11 = 3 THEN 'short' WHEN SegmentID % 11 = 5 THEN 'long' WHEN SegmentID % 11 = 7 THEN 'value' END AS fault FROM sensors) GROUP BY fault""", "sensors"))
def _by_fault(i: Inputs) -> DataFrame:
    """Sensor counts as CSV, some of whose rows are cut, extended or no numbers, loaded through the quarantine."""
    root = _folder(i, "csv")
    names = readers.SENSOR_COUNTS_SCHEMA.fieldNames()
    quoted = [F.coalesce(F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"')), F.lit("")) for c in names]
    kind = F.col("SegmentID") % 11
    cells: Column = F.when(kind == 3, F.array(*quoted[:5])).when(kind == 5, F.array(*quoted, F.lit("more"))).when(kind == 7, F.array(*quoted[:3], F.lit("no year"), *quoted[4:])).otherwise(F.array(*quoted))
    i.sensors.select(F.array_join(cells, ",").alias("value")).write.text(f"{root}/in")
    loaded = quarantine.load(i.spark, f"{root}/in", readers.SENSOR_COUNTS_SCHEMA, f"{root}/out", header=False)
    good = loaded.good.agg(F.lit(None).cast("string").alias("fault"), F.count(F.lit(1)).alias("n_rows"), F.sum(parse_int("Vol")).alias("volume"))
    return good.unionByName(loaded.bad.groupBy("fault").agg(F.count(F.lit(1)).alias("n_rows"), F.lit(None).cast("bigint").alias("volume")))


# ---- '::' text in latin-1 (A3, A4), a lookup file (A5) ----------------------------------------
@register("ratings_from_text", with_views("""
SELECT rating, CAST(count(*) AS BIGINT) AS n_ratings, CAST(count(DISTINCT user_id) AS BIGINT) AS n_users, min(ts) AS first_ts, max(ts) AS last_ts FROM ratings GROUP BY rating""", "ratings"))
def _ratings_text(i: Inputs) -> DataFrame:
    path = _folder(i, "ratings")
    i.ratings.select("user_id", "item_id", "rating", "ts").write.option("sep", "::").option("encoding", "ISO-8859-1").csv(path)
    return readers.load_ratings(i.spark, path).groupBy("rating").agg(
        F.count(F.lit(1)).alias("n_ratings"), F.count_distinct("user_id").alias("n_users"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@register("movies_from_text", with_views("SELECT CAST(item_id AS INTEGER) AS item_id, 'é ' || title AS title, genres FROM movies", "movies"))
def _movies_text(i: Inputs) -> DataFrame:
    path = _folder(i, "movies")
    i.movies.select("item_id", F.concat(F.lit("é "), "title"), "genres").write.option("sep", "::").option("encoding", "ISO-8859-1").csv(path)
    return readers.load_movies(i.spark, path)


@register("zones_from_lookup_file", with_views("SELECT CAST(LocationID AS INTEGER) AS LocationID, CASE WHEN LocationID % 9 = 0 THEN NULL ELSE Boro_Name END AS Boro_Name FROM zones", "zones"))
def _zones_file(i: Inputs) -> DataFrame:
    path = _folder(i, "zones")
    name = F.when(F.col("LocationID") % 9 == 0, F.when(F.col("LocationID") % 2 == 0, " Unknown").otherwise("N/A")).otherwise(F.concat(F.lit(" "), "Boro_Name", F.lit(" ")))
    i.zones.select("LocationID", name.alias("Borough"), F.lit("z").alias("Zone"), F.lit("s").alias("service_zone")).write.option("header", True).csv(path)
    return readers.read_lookup(i.spark, path)


# ---- one-file reports read back (A8, A9) ------------------------------------------------------
@register("kpi_report_read_back", _trip_sql(_kpi_sql(["pickup_boro"], kpi.ZONE_METRICS)))
def _report_back(i: Inputs) -> DataFrame:
    path = _folder(i, "report")
    report = jobs.kpi_by_zone(i.consolidated)
    sinks.write_report_csv(report, path)
    return readers.read_report_csv(i.spark, path, report.schema)


# ---- catalogue and vectors, versioned by their input (A10, A11, A14) -----------------------
@register("versioned_vectors", with_views("""
SELECT v.item_id, CAST(len(v.embedding) AS INTEGER) AS width, round(list_sum(list_transform(v.embedding, lambda x: CAST(x AS DOUBLE))), 4) AS total, m.title
FROM vectors v LEFT JOIN movies m USING (item_id)""", "vectors", "movies"))
def _versioned(i: Inputs) -> DataFrame:
    import os

    def write(folder: str) -> None:
        sinks.write_vectors(i.vectors, f"{folder}/vectors")
        sinks.write_parquet(i.movies, f"{folder}/catalogue")

    inputs = {t: os.path.join(i.sf_dir, f"{t}.parquet") for t in ("embeddings", "part")}
    folder = versions.build(i.spark, f"{checkpoint_dir(i.spark)}/catalogue", inputs, write)
    v = readers.read_vectors(i.spark, f"{folder}/vectors")
    total = F.aggregate(F.transform("embedding", lambda x: x.cast("double")), F.lit(0.0), lambda a, x: a + x)
    return v.join(readers.read_parquet(i.spark, f"{folder}/catalogue", ["item_id", "title"]), "item_id", "left").select("item_id", F.size("embedding").alias("width"), F.round(total, 4).alias("total"), "title")


# ---- result documents as JSON (A13) -----------------------------------------------------------
@register("documents_from_json", ORACLE_SQL["recommendation_documents"])
def _json(i: Inputs) -> DataFrame:
    path = _folder(i, "json")
    docs = recsys.recommendation_documents(i.ratings, i.vectors, i.movies, i.slices, GENERATED_AT)
    sinks.write_recommendations_json(docs, path)
    # NULL fields are absent from a document
    return i.spark.read.schema(docs.schema).json(path).select(*docs.columns).withColumn("Recommendations", F.array_join("Recommendations", " | "))


# ---- bucketed trips and features (A7, P3, P5): no exchange between them ---------------------------
@register("bucketed_trip_join", _trip_sql("""
SELECT Hour_Bin, CAST(count(*) AS BIGINT) AS n_trips, round(sum(t.total_amount), 2) AS total_amount
FROM (SELECT trip_id, sum(total_amount) AS total_amount FROM clean GROUP BY trip_id) t
JOIN (SELECT trip_id, min(Hour_Bin) AS Hour_Bin FROM consolidated GROUP BY trip_id) f USING (trip_id) GROUP BY Hour_Bin"""))
def _bucketed(i: Inputs) -> DataFrame:
    name = uuid.uuid4().hex
    trips = layout.write_bucketed(i.clean.select("trip_id", "total_amount"), f"trips_{name}", _folder(i, "trips"), "trip_id", 8)
    features = layout.write_bucketed(i.consolidated.select("trip_id", "Hour_Bin"), f"features_{name}", _folder(i, "features"), "trip_id", 8)
    once = trips.groupBy("trip_id").agg(F.sum("total_amount").alias("total_amount"))
    found = layout.join_on_key(features.groupBy("trip_id").agg(F.min("Hour_Bin").alias("Hour_Bin")), once, "trip_id", "inner")
    return found.groupBy("Hour_Bin").agg(F.count(F.lit(1)).alias("n_trips"), F.round(F.sum("total_amount"), 2).alias("total_amount"))


# ---- the quality report's tables from the cells of one scan (P6) ------------------------------
@register("inspected_trips", with_views(_describe_sql("trips", _DESCRIBE_COLS, _DESCRIBE_STATS), "trips"))
def _inspected(i: Inputs) -> DataFrame:
    return inspect(i.trips, ["PULocationID"], described=_DESCRIBE_COLS).describe(digits=6)


@register("inspected_sensor_coverage", ORACLE_SQL["segment_coverage"])
def _inspected_coverage(i: Inputs) -> DataFrame:
    return inspect(i.sensors, ["SegmentID", "Boro", "Yr", "HH"], jobs.sensor_rules(), {"Vol_numeric": nullify_sentinels(parse_int("Vol"))}).coverage("SegmentID")


@register("inspected_sensor_rules", ORACLE_SQL["rule_violations_sensors"])
def _inspected_rules(i: Inputs) -> DataFrame:
    return inspect(i.sensors, ["SegmentID", "HH"], jobs.sensor_rules()).broken_rules()


# ---- state by iteration (A12): a partition is read alone --------------------------------------
@register("stored_state_of_an_iteration", _rec_sql("""
SELECT iteration, CAST(count(*) AS BIGINT) AS n_users, CAST(sum(n) AS BIGINT) AS n_liked FROM (
  SELECT iteration, user_id, count(*) AS n FROM cum WHERE rating >= 4 GROUP BY iteration, user_id) WHERE iteration = 2 GROUP BY iteration"""))
def _state(i: Inputs) -> DataFrame:
    path = _folder(i, "state")
    liked = recsys.cumulative_aggregate(recsys.assign_segment(i.ratings.where("rating >= 4"), i.slices), ["user_id"], i.slices, {"n": ("count", None)})
    sinks.write_state(liked, path)
    return readers.read_state(i.spark, path, 2).groupBy("iteration").agg(F.count(F.lit(1)).alias("n_users"), F.sum("n").alias("n_liked"))
