import math

import numpy as np
from pyspark.sql import functions as F

from urbanlens.operators import kpi, profile, quality
from urbanlens.plans import jobs

from .conftest import rows


def sensor_raw(spark):
    data = [
        # SegmentID, Boro, street, Yr, M, D, HH, MM, Vol
        (1, "Bronx", "A St", 2024, 1, 1, 7, 0, "1,147"),  # Monday
        (1, "Bronx", "A St", 2024, 1, 8, 7, 15, "10"),
        (1, "Bronx", "A St", 2024, 1, 15, 7, 30, "20"),  # group of 3 -> middle
        (2, "Bronx", "B St", 2024, 1, 1, 8, 0, "5"),
        (2, "Bronx", "B St", 2024, 1, 8, 8, 0, "7"),  # group of 2 -> lower median
        (3, "Queens", "C St", 2024, 1, 1, 9, 0, "-1"),
        (3, "Queens", "C St", 2024, 1, 8, 9, 0, "999"),  # all-NULL volumes -> NULL median
        (4, "Queens", "D St", 2024, 13, 1, 9, 0, "5"),  # bad month -> NULL weekday group
        (None, "Queens", "E St", 2024, 1, 1, 9, 0, "5"),  # no segment: dropped
        (5, None, "F St", 2024, 1, 1, 9, 0, "5"),  # no borough: dropped
        (6, "Bronx", "G St", 2024, 1, 1, 7, 0, "abc"),
    ]
    return spark.createDataFrame(data, "SegmentID int, Boro string, street string, Yr int, M int, D int, HH int, MM int, Vol string")


def test_median_profile(spark):
    prof = {(r.SegmentID, r.day_of_week): r.historical_median_volume for r in jobs.sensor_profile(sensor_raw(spark)).collect()}
    assert prof[(1, 2)] == 20  # median of 10, 20, 1147
    assert prof[(2, 2)] == 5  # lower median of 5, 7
    assert prof[(3, 2)] is None
    assert prof[(4, None)] == 5
    assert (5, 2) not in prof and all(k[0] is not None for k in prof)
    approx = {(r.SegmentID, r.day_of_week): r.historical_median_volume
              for r in jobs.sensor_profile(sensor_raw(spark), method="approx").collect()}
    assert approx == prof  # small groups: the sketch is exact


def test_rollup_profile_one_row_group_has_null_stddev(spark):
    z = {(r.Boro, r.day_of_week, r.HH): r for r in jobs.zone_profile(sensor_raw(spark)).collect()}
    r = z[("Bronx", 2, 7)]
    assert r.boro_avg_median_volume == 20.0 and r.boro_max_volume == 20 and r.boro_volume_stddev is None


def test_coverage_and_counts(spark):
    df = spark.createDataFrame([(k,) for k, n in [(1, 1), (2, 2), (3, 3), (4, 4)] for _ in range(n)], "k int")
    cov = profile.coverage(df, "k").collect()[0]
    assert (cov.n_keys, cov.min_rows, cov.p25_rows, cov.p50_rows, cov.p75_rows, cov.max_rows) == (4, 1, 1, 2, 3, 4)
    low = kpi.bottom_n(profile.key_counts(df, "k"), "n_rows", 2, ["k"]).collect()
    assert [r.k for r in low] == [1, 2]


def test_quality_reports(spark):
    df = spark.createDataFrame([(1.0, None), (None, "x"), (3.0, "y")], "a double, B_col string")
    assert rows(quality.null_counts(df)) == [(1, 1)]
    assert {r.column_name: r.null_count for r in quality.null_counts_long(df).collect()} == {"a": 1, "B_col": 1}
    rc = quality.rule_counts(df, {"a_big": F.col("a") > 2, "a_small": F.col("a") < 2}).collect()[0]
    assert (rc.a_big, rc.a_small) == (1, 1)
    rep = quality.table_report(df).collect()
    assert [(r.column_name, r.data_type, r.ordinal_position, r.row_count) for r in rep] == [
        ("a", "double", 1, 3), ("B_col", "string", 2, 3)]
    assert quality.columns_matching(df, names=["A", "missing"], contains=["col"]) == ["a", "B_col"]
    rr = quality.rows_removed(df, F.col("a").isNotNull()).collect()[0]
    assert (rr.rows_before, rr.rows_after, rr.rows_removed) == (3, 2, 1)


def test_describe_matches_numpy(spark):
    rng = np.random.default_rng(1)
    vals = rng.normal(10, 3, 500).tolist()
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    d = {r.statistic: r.x for r in quality.describe(df, ["x"]).collect()}
    assert d["count"] == 500
    assert math.isclose(d["mean"], np.mean(vals), rel_tol=1e-12)
    assert math.isclose(d["stddev"], np.std(vals, ddof=1), rel_tol=1e-9)
    assert d["min"] == min(vals) and d["max"] == max(vals)
    # sketch quartile: rank error within n / accuracy of the exact rank
    q = {r.statistic: r.x for r in quality.describe(df, ["x"], ["25%", "50%"]).collect()}
    srt = sorted(vals)
    for key, p in (("25%", 0.25), ("50%", 0.5)):
        rank = srt.index(q[key])
        assert abs(rank - p * 500) <= 2


def test_kpi_and_correlations(spark):
    df = spark.createDataFrame(
        [("A", 10.0, 1.0, 5.0), ("A", 20.0, 2.0, 5.0), ("B", 30.0, 3.0, 5.0), ("B", 41.0, 4.0, 5.0)],
        "Hour_Bin string, fare_amount double, trip_distance double, const double",
    )
    k = {r.Hour_Bin: r for r in kpi.kpi(df, ["Hour_Bin"], [("avg_fare", "fare_amount", 2)]).collect()}
    assert k["A"].trip_count == 2 and k["B"].avg_fare == 35.5
    c = kpi.correlations(df, {"d": "trip_distance", "c": "const"}).collect()[0]
    assert math.isclose(c.d, np.corrcoef([1, 2, 3, 4], [10, 20, 30, 41])[0, 1], abs_tol=1e-6)
    assert c.c is None  # constant column: NULL instead of an ANSI error


def test_pivot_and_reindex(spark):
    df = spark.createDataFrame([("X", "Peak", 1.0), ("X", "Off_Peak", 2.0), ("Y", "Peak", 3.0)],
                               "pickup_boro string, period string, avg_fare double")
    p = rows(kpi.pivot_metric(df, "pickup_boro", "period", ["Peak", "Off_Peak"], "avg_fare"))
    assert p == [("X", 1.0, 2.0), ("Y", 3.0, None)]
    t = spark.createDataFrame([("Evening_Rush", 5)], "Hour_Bin string, trip_count int")
    r = kpi.reindex(spark, t, "Hour_Bin", kpi.HOUR_BIN_ORDER).collect()
    assert [x.Hour_Bin for x in r] == list(kpi.HOUR_BIN_ORDER)
    assert [x.trip_count for x in r] == [None, None, 5, None]


def test_top_n_ties(spark):
    df = spark.createDataFrame([(3, 48), (1, 48), (2, 48), (4, 50)], "item_id int, n int")
    assert [r.item_id for r in kpi.top_n(df, "n", 3, ["item_id"]).collect()] == [4, 1, 2]
