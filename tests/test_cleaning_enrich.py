import pytest
from pyspark.sql import functions as F

from urbanlens.operators import cleaning, enrich
from urbanlens.plans import jobs

from .conftest import rows

TRIP_SCHEMA = (
    "id int, fare_amount double, trip_distance double, passenger_count double, RatecodeID double, "
    "store_and_fwd_flag string, congestion_surcharge double, Airport_fee double"
)


def trip_rows():
    # id, fare, distance, passengers, ratecode, flag, surcharge, airport
    return [
        (1, 0.0, 5.0, 1.0, 1.0, "N", 0.0, 0.0),  # fare 0
        (2, -5.0, 5.0, 1.0, 1.0, "N", 0.0, 0.0),  # negative fare
        (3, 800.0, 5.0, 1.0, 1.0, "N", 0.0, 0.0),  # fare on the upper bound: kept
        (4, 800.01, 5.0, 1.0, 1.0, "N", 0.0, 0.0),
        (5, 10.0, 0.0, 1.0, 1.0, "N", 0.0, 0.0),  # distance 0
        (6, 10.0, 100.0, 1.0, 1.0, "N", 0.0, 0.0),  # distance on bound: kept
        (7, 10.0, 100.01, 1.0, 1.0, "N", 0.0, 0.0),
        (8, 10.0, 5.0, 0.0, 1.0, "N", 0.0, 0.0),  # zero passengers
        (9, 10.0, 5.0, None, 1.0, "N", 0.0, 0.0),  # NULL passengers dropped before imputation
        (10, 10.0, 5.0, 2.0, None, None, None, None),  # all four imputed
    ]


def test_filter_valid_bounds(spark):
    df = spark.createDataFrame(trip_rows(), TRIP_SCHEMA)
    kept = [r.id for r in cleaning.filter_valid(df).collect()]
    assert sorted(kept) == [3, 6, 10]


def test_imputation_after_filter(spark):
    df = spark.createDataFrame(trip_rows(), TRIP_SCHEMA)
    out = {r.id: r for r in jobs.clean_trips(df).collect()}
    r = out[10]
    assert (r.RatecodeID, r.store_and_fwd_flag, r.congestion_surcharge, r.Airport_fee) == (1.0, "N", 0.0, 0.0)
    with pytest.raises(ValueError):
        cleaning.impute_constants(df, {"no_such_column": 1})


def test_guardrails_edges(spark):
    data = [(0.99, 0.1, 1.0), (1.0, 0.1, 1.0), (180.0, 0.1, 1.0), (180.01, 0.1, 1.0),
            (10.0, 0.0329, 1.0), (10.0, 0.033, 1.0), (10.0, 1.33, 1.0), (10.0, 1.3301, 1.0), (10.0, 0.1, 0.0)]
    df = spark.createDataFrame(data, "trip_duration double, average_velocity double, trip_distance double")
    kept = rows(jobs.apply_guardrails(df))
    assert kept == sorted([(1.0, 0.1, 1.0), (180.0, 0.1, 1.0), (10.0, 0.033, 1.0), (10.0, 1.33, 1.0)])


def test_exclude_values_keeps_nulls(spark):
    df = spark.createDataFrame([("A", 10), ("B", 1), (None, 5)], "pickup_boro string, trip_count long")
    assert rows(cleaning.exclude_values(df, "pickup_boro", ["A"])) == [("B", 1), (None, 5)]
    assert rows(cleaning.exclude_values(df, "pickup_boro", min_rows=5)) == [("A", 10), (None, 5)]


@pytest.fixture()
def lookup_tables(spark):
    trips = spark.createDataFrame(
        [(1, 10, 20, 1, 8), (2, 10, 10, 7, 17), (3, 99, 20, 2, 3)],
        "trip_id int, PULocationID int, DOLocationID int, pickup_day_of_week int, pickup_hour int",
    )
    zones = spark.createDataFrame([(10, "Manhattan"), (20, "Queens")], "LocationID int, Boro_Name string")
    profile = spark.createDataFrame(
        [("Manhattan", 1, 8, 100.0, 150, 10.0), ("Queens", 1, 8, 50.0, 70, None), ("Manhattan", 7, 17, 200.0, 220, 5.0)],
        "Boro string, day_of_week int, HH int, boro_avg_median_volume double, boro_max_volume int, "
        "boro_volume_stddev double",
    )
    return trips, zones, profile


def test_lookup_both_roles_and_profiles(spark, lookup_tables):
    trips, zones, profile = lookup_tables
    z = jobs.with_zones(trips, zones)
    assert z.count() == 3  # left joins keep cardinality (unique dimension key)
    got = {r.trip_id: (r.pickup_boro, r.dropoff_boro) for r in z.collect()}
    assert got == {1: ("Manhattan", "Queens"), 2: ("Manhattan", "Manhattan"), 3: (None, "Queens")}
    p = jobs.with_profiles(z, profile)
    out = {r.trip_id: r for r in p.collect()}
    # dropoff side matched on the *pickup* weekday/hour
    assert out[1].pickup_avg_median_volume == 100.0 and out[1].dropoff_avg_median_volume == 50.0
    assert out[2].pickup_volume_stddev == 5.0 and out[2].dropoff_max_volume == 220
    assert out[3].pickup_avg_median_volume is None  # unmatched zone -> NULL
    assert [r.trip_id for r in enrich.filter_cross_zone(z).collect()] == [1]
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 3


def test_assert_unique_rejects_duplicate_key(spark):
    dup = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "LocationID int, Boro_Name string")
    with pytest.raises(ValueError):
        enrich.assert_unique(dup, ["LocationID"])
    enrich.assert_unique(dup.filter("LocationID = 2"), ["LocationID"])


def test_join_audit(spark, lookup_tables):
    trips, zones, _ = lookup_tables
    z = jobs.with_zones(trips, zones)
    audit = {r.metric: r.value for r in enrich.join_audit(trips, z, ["pickup_boro", "dropoff_boro"]).collect()}
    assert audit == {"rows_before": 3, "rows_after": 3, "unmatched_pickup_boro": 1, "unmatched_dropoff_boro": 0}


def test_profile_by_zone_equals_one_join_per_role(spark, lookup_tables):
    trips, zones, profile = lookup_tables
    z = jobs.with_zones(trips, zones)
    one = enrich.attach_profile_by_zone(
        z, profile, {"pickup_day_of_week": "day_of_week", "pickup_hour": "HH"}, "Boro",
        {"pu": ("pickup_boro", {"boro_avg_median_volume": "pu_avg", "boro_volume_stddev": "pu_sd"}),
         "do": ("dropoff_boro", {"boro_max_volume": "do_max"})},
    )
    side = lambda key, names: profile.select(
        F.col("Boro").alias(key), F.col("day_of_week").alias("pickup_day_of_week"), F.col("HH").alias("pickup_hour"),
        *[F.col(c).alias(n) for c, n in names.items()])
    keys = ["pickup_day_of_week", "pickup_hour"]
    a = z.join(side("pickup_boro", {"boro_avg_median_volume": "pu_avg", "boro_volume_stddev": "pu_sd"}), ["pickup_boro", *keys], "left")
    two = a.join(side("dropoff_boro", {"boro_max_volume": "do_max"}), ["dropoff_boro", *keys], "left")
    assert rows(one) == rows(two.select(*one.columns))
