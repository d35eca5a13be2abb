"""Driver test tables re-shaped into the engine's input tables.

The driver ships TPC-H-style tables; these views give them the shapes of the
surveyed inputs (taxi trips, a zone lookup, raw sensor counts, a catalogue, item
vectors, ratings). Each view exists twice, with the same expressions in the
same order so doubles come out bit-identical: a Spark DataFrame function and a
DuckDB CTE (used by the oracle SQL).
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one driver table, as laid out on disk."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# --------------------------------------------------------------------------- trips
def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips: lineitem ⋈ orders ⋈ customer ⋈ supplier.

    The joins are plain inner equi-joins without hints: ``orders`` is a fact table
    of its own, so the optimizer (and AQE at runtime) picks broadcast vs
    sort-merge from the measured sizes.
    """
    # Each derived value is computed on the side that owns its inputs, before the
    # joins (l_orderkey = o_orderkey, so the pickup hour is an orders-side value);
    # a predicate later pushed into the join then reuses these columns.
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate",
        (F.col("o_orderkey") % 24).cast("int").alias("pu_hour_offset"),
    ).withColumn("tpep_pickup_datetime", F.timestamp_add("HOUR", F.col("pu_hour_offset"), F.col("o_orderdate")))
    li = table(spark, sf_dir, "lineitem").withColumn(
        "trip_minutes",
        (
            F.floor(F.col("l_quantity") * (F.col("l_suppkey") % 5))
            + F.when(F.col("l_linenumber") == 7, 200).otherwise(0)
        ).cast("int"),
    )
    c = table(spark, sf_dir, "customer")
    s = table(spark, sf_dir, "supplier")
    # customers join the orders, a quarter of the line items, which then move once
    j = (
        li.join(o.join(c, o.o_custkey == c.c_custkey), li.l_orderkey == o.o_orderkey)
        .join(s, li.l_suppkey == s.s_suppkey)
    )
    hours = F.col("pu_hour_offset")
    pickup = F.col("tpep_pickup_datetime")
    fare = F.col("l_extendedprice") / 100
    extra = F.when(hours.between(16, 19), 2.5).otherwise(1.0)
    mta_tax = F.lit(0.5)
    tolls = F.col("l_tax")
    surcharge = F.nullif(F.col("l_discount"), F.lit(0.0))
    airport = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(1.75))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("double"))
        .otherwise(F.lit(0.0))
    )
    cbd = F.when(F.col("c_mktsegment") == "BUILDING", 0.75).otherwise(0.0)
    total = fare + extra + mta_tax + tolls + F.coalesce(surcharge, F.lit(0.0)) + F.coalesce(airport, F.lit(0.0)) + cbd
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trip_id"),
        pickup.alias("tpep_pickup_datetime"),
        F.timestamp_add("MINUTE", F.col("trip_minutes"), pickup).alias("tpep_dropoff_datetime"),
        F.col("c_nationkey").alias("PULocationID"),
        F.col("s_nationkey").alias("DOLocationID"),
        F.nullif(F.col("l_linenumber"), F.lit(6)).cast("double").alias("passenger_count"),
        ((F.col("l_quantity") - 1) * 2.2).alias("trip_distance"),
        F.nullif(F.col("l_linenumber") % 4, F.lit(0)).cast("double").alias("RatecodeID"),
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("store_and_fwd_flag"),
        F.col("l_linestatus").alias("payment_type"),
        fare.alias("fare_amount"),
        extra.alias("extra"),
        mta_tax.alias("mta_tax"),
        tolls.alias("tolls_amount"),
        total.alias("total_amount"),
        surcharge.alias("congestion_surcharge"),
        airport.alias("Airport_fee"),
        cbd.alias("cbd_congestion_fee"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup ``(LocationID, Boro_Name)`` from nation ⋈ region (25 rows)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("LocationID"), F.col("r_name").alias("Boro_Name")
    )


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sensor counts with text volumes (thousands commas, ``-1`` on errors)."""
    e = table(spark, sf_dir, "events")
    r = table(spark, sf_dir, "region")  # 5 rows: broadcast is size-safe
    vol = F.floor(F.col("value") * 10).cast("bigint")
    j = e.join(F.broadcast(r), (e.user_id % 5) == r.r_regionkey)
    return j.select(
        F.col("user_id").cast("int").alias("SegmentID"),
        F.col("r_name").alias("Boro"),
        F.col("event_type").alias("street"),
        F.year("ts").alias("Yr"),
        F.month("ts").alias("M"),
        F.dayofmonth("ts").alias("D"),
        F.hour("ts").alias("HH"),
        F.minute("ts").alias("MM"),
        F.when(F.col("event_type") == "error", F.lit("-1")).otherwise(F.format_number(vol, 0)).alias("Vol"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.concat(F.col("p_type"), F.lit("|"), F.col("p_brand")).alias("genres"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item_id"), "embedding")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, item_id, rating 1..5, ts epoch seconds)`` from orders ⋈ lineitem."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("int").alias("rating"),
        F.unix_timestamp(F.col("o_orderdate")).alias("ts"),
    )


# Fixed values of the test mapping: cumulative slices start on FIRST_DAY and
# iteration i ends with LAST_DAYS[i] (UTC days); the last one is open.
FIRST_DAY = dt.date(1995, 1, 1)
LAST_DAYS: tuple[dt.date | None, ...] = (dt.date(1996, 12, 31), dt.date(1998, 12, 31), dt.date(2000, 6, 30), None)


# --------------------------------------------------------------------------- SQL
# The same views as DuckDB CTEs (tables are pre-registered under their names).
SQL_VIEWS: dict[str, str] = {
    "trips": """trips AS (
  SELECT
    l.l_orderkey * 10 + l.l_linenumber AS trip_id,
    o.o_orderdate + to_hours(CAST(l.l_orderkey % 24 AS BIGINT)) AS tpep_pickup_datetime,
    o.o_orderdate + to_hours(CAST(l.l_orderkey % 24 AS BIGINT))
      + to_minutes(CAST(floor(l.l_quantity * (l.l_suppkey % 5)) + CASE WHEN l.l_linenumber = 7 THEN 200 ELSE 0 END AS BIGINT)) AS tpep_dropoff_datetime,
    c.c_nationkey AS PULocationID,
    s.s_nationkey AS DOLocationID,
    CAST(NULLIF(l.l_linenumber, 6) AS DOUBLE) AS passenger_count,
    (l.l_quantity - 1) * 2.2 AS trip_distance,
    CAST(NULLIF(l.l_linenumber % 4, 0) AS DOUBLE) AS RatecodeID,
    NULLIF(l.l_returnflag, 'R') AS store_and_fwd_flag,
    l.l_linestatus AS payment_type,
    l.l_extendedprice / 100 AS fare_amount,
    CASE WHEN l.l_orderkey % 24 BETWEEN 16 AND 19 THEN 2.5::DOUBLE ELSE 1.0::DOUBLE END AS extra,
    0.5::DOUBLE AS mta_tax,
    l.l_tax AS tolls_amount,
    l.l_extendedprice / 100 + CASE WHEN l.l_orderkey % 24 BETWEEN 16 AND 19 THEN 2.5::DOUBLE ELSE 1.0::DOUBLE END + 0.5::DOUBLE + l.l_tax
      + coalesce(NULLIF(l.l_discount, 0.0), 0.0::DOUBLE)
      + coalesce(CASE WHEN o.o_orderpriority = '1-URGENT' THEN 1.75::DOUBLE WHEN o.o_orderpriority = '5-LOW' THEN NULL ELSE 0.0::DOUBLE END, 0.0::DOUBLE)
      + CASE WHEN c.c_mktsegment = 'BUILDING' THEN 0.75::DOUBLE ELSE 0.0::DOUBLE END AS total_amount,
    NULLIF(l.l_discount, 0.0) AS congestion_surcharge,
    CASE WHEN o.o_orderpriority = '1-URGENT' THEN 1.75::DOUBLE WHEN o.o_orderpriority = '5-LOW' THEN NULL ELSE 0.0::DOUBLE END AS Airport_fee,
    CASE WHEN c.c_mktsegment = 'BUILDING' THEN 0.75::DOUBLE ELSE 0.0::DOUBLE END AS cbd_congestion_fee
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
)""",
    "zones": """zones AS (
  SELECT n.n_nationkey AS LocationID, r.r_name AS Boro_Name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)""",
    "sensors": """sensors AS (
  SELECT
    CAST(e.user_id AS INTEGER) AS SegmentID,
    r.r_name AS Boro,
    e.event_type AS street,
    CAST(year(e.ts) AS INTEGER) AS Yr,
    CAST(month(e.ts) AS INTEGER) AS M,
    CAST(day(e.ts) AS INTEGER) AS D,
    CAST(hour(e.ts) AS INTEGER) AS HH,
    CAST(minute(e.ts) AS INTEGER) AS MM,
    CASE WHEN e.event_type = 'error' THEN '-1'
         ELSE format('{:,}', CAST(floor(e.value * 10) AS BIGINT)) END AS Vol
  FROM events e JOIN region r ON e.user_id % 5 = r.r_regionkey
)""",
    "movies": """movies AS (
  SELECT p_partkey AS item_id, p_name AS title, p_type || '|' || p_brand AS genres FROM part
)""",
    "vectors": """vectors AS (
  SELECT vec_id AS item_id, embedding FROM embeddings
)""",
    "ratings": """ratings AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_id,
         CAST(floor((l.l_quantity - 1) / 10) + 1 AS INTEGER) AS rating,
         CAST(epoch(o.o_orderdate) AS BIGINT) AS ts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)""",
}


def sql_bounds_cte() -> str:
    """Half-open epoch bounds ``[lo, hi)`` of each iteration."""
    first = f"CAST(epoch(DATE '{FIRST_DAY}') AS BIGINT)"
    after = ["NULL" if d is None else f"CAST(epoch(DATE '{d}' + 1) AS BIGINT)" for d in LAST_DAYS]
    rows = ", ".join(f"({i}, {first}, {hi})" for i, hi in enumerate(after))
    return f"bounds AS (SELECT * FROM (VALUES {rows}) AS t(iteration, lo, hi))"


def with_views(sql_body: str, *views: str, extra_ctes: list[str] | None = None) -> str:
    """Prefix ``sql_body`` (which may start with its own ``name AS (...)`` CTEs
    via ``extra_ctes``) with the named views."""
    ctes = [SQL_VIEWS[v] if v != "bounds" else sql_bounds_cte() for v in views]
    ctes += extra_ctes or []
    return "WITH " + ",\n".join(ctes) + "\n" + sql_body
