"""Physical-plan properties that the scale design relies on."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from urbanlens.operators import recsys
from urbanlens.plans import catalog, jobs
from urbanlens.sources import testdata

from .conftest import SF_SMALL


def plan_of(df) -> str:
    """Physical plan text (the initial adaptive plan; no job is run)."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def trips_parquet(spark):
    import tempfile

    path = os.path.join(tempfile.mkdtemp(prefix="run-", dir="/tmp"), "trips")
    testdata.trips(spark, SF_SMALL).write.parquet(path)
    return path


def test_cleaning_filters_reach_the_parquet_scan(spark, trips_parquet):
    df = jobs.clean_trips(spark.read.parquet(trips_parquet)).select("fare_amount")
    plan = plan_of(df)
    # the plan text truncates long filter lists, so check the visible prefix
    assert "PushedFilters: [IsNotNull(fare_amount), GreaterThan(fare_amount,0.0), LessThanOrEqual(fare_amount,800.0)" in plan
    # only the three filtered columns are read, though a single column is selected afterwards
    assert "ReadSchema: struct<passenger_count:double,trip_distance:double,fare_amount:double>" in plan


def test_report_scans_only_needed_columns(spark, trips_parquet):
    df = spark.read.parquet(trips_parquet).groupBy("payment_type").agg(F.avg("fare_amount"))
    plan = plan_of(df)
    assert "ReadSchema: struct<payment_type:string,fare_amount:double>" in plan
    assert "partial_avg" in plan  # map-side partial aggregation before the shuffle


def test_no_join_is_forced_to_broadcast(spark):
    """With the size limit at zero every lookup and profile join is a sort-merge join: nothing
    is broadcast whatever its size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(jobs.with_profiles(
            jobs.with_zones(jobs.with_pickup_keys(catalog.Inputs(spark, SF_SMALL).clean), catalog.Inputs(spark, SF_SMALL).zones.select("*")),
            catalog.Inputs(spark, SF_SMALL).zprofile,
        ))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") >= 3


def test_no_round_robin_shuffle_of_scans(spark):
    i = catalog.Inputs(spark, SF_SMALL)
    for df in (i.trips, i.sensors, i.ratings):
        assert "RoundRobinPartitioning" not in plan_of(df)


def test_topk_plans_partial_group_limit(spark):
    i = catalog.Inputs(spark, SF_SMALL)
    plan = plan_of(recsys.cold_recommendations(i.ratings, i.movies, i.slices))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_kpi_aggregates_partially(spark):
    plan = plan_of(entry.entry(spark))
    assert "partial_count" in plan and "partial_avg" in plan


def test_no_registered_query_builds_all_pairs(spark):
    bad = {}
    for name in catalog.QUERIES:
        fn = entry.queries()[name]
        if name in {"fare_model_metrics", "fare_model_importance", "scored_by_hour_bin", "scored_by_zone"}:
            continue  # fitted model plans are covered by the model tests
        plan = plan_of(fn(spark, SF_SMALL))
        for op in ("CartesianProduct", "BroadcastNestedLoopJoin"):
            if op in plan:
                bad[name] = op
    assert not bad, bad


def test_hot_key_aggregations_run_partial_first(spark):
    """A user or sensor group holding a third of all rows is combined per task
    before the shuffle: the vector sums and exact medians have partial phases."""
    i = catalog.Inputs(spark, SF_SMALL)
    taste = plan_of(recsys.taste_vectors(i.ratings, i.vectors, i.slices))
    assert "partial_sum" in taste and "partial_count" in taste and taste.count("ObjectHashAggregate") >= 4
    assert "collect_list" not in taste
    median = plan_of(jobs.sensor_profile(i.sensors))
    assert "partial_percentile_disc" in median
