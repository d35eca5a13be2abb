import math

from pyspark.sql import functions as F

from urbanlens.operators import kpi, sketches
from urbanlens.plans import catalog, jobs

from .conftest import SF_SMALL


def table(spark, n=40_000):
    return spark.range(n).select(
        F.col("id"), (F.col("id") % 13).alias("part"), F.when(F.col("id") % 10 > 0, F.col("id") * 0.5).alias("x"),
        (F.col("id") % 300).cast("string").alias("name"), F.lit(None).cast("double").alias("none"),
    )


def test_parts_merge_to_the_whole_within_bounds(spark):
    df = table(spark)
    parts = sketches.sketch(df, ["id", "x", "name", "none"], numeric=["id", "x", "none"], by=["part"])
    got = {r.column_name: r for r in sketches.report(sketches.merge(parts)).collect()}
    one = {r.column_name: r for r in sketches.report(sketches.sketch(df, ["id", "x", "name", "none"], numeric=["id", "x", "none"])).collect()}
    exact = df.agg(F.avg("x"), F.stddev_samp("x"), F.min("x"), F.max("x")).first()
    for r in (got["x"], one["x"]):
        assert (r.n_rows, r.nulls, r.least, r.most) == (40_000, 4000, exact[2], exact[3])
        assert math.isclose(r.mean, exact[0], rel_tol=1e-12) and math.isclose(r.stddev, exact[1], rel_tol=1e-9)
        for q, estimate in zip(sketches.QUANTILES, r.quantiles, strict=True):
            rank = df.where(F.col("x") <= estimate).count() / 36_000
            assert abs(rank - q) <= sketches.RANK_ERROR
    for name, exactly in (("id", 40_000), ("x", 36_000), ("name", 300)):
        assert abs(got[name].distinct_estimate - exactly) <= math.ceil(exactly * sketches.DISTINCT_ERROR)
        assert abs(one[name].distinct_estimate - exactly) <= math.ceil(exactly * sketches.DISTINCT_ERROR)
    assert got["none"].nulls == 40_000 and got["none"].mean is None and got["none"].quantiles is None and got["name"].mean is None


def test_stored_parts_take_new_ones_without_old_data(spark, scratch):
    df = table(spark, 5000)
    for p in range(3):
        sketches.sketch(df.where(F.col("part") % 3 == p), ["x", "name"], numeric=["x"], by=["part"]).write.mode("append").parquet(f"{scratch}/parts")
    stored = sketches.report(sketches.merge(spark.read.parquet(f"{scratch}/parts"))).collect()
    fresh = sketches.report(sketches.merge(sketches.sketch(df, ["x", "name"], numeric=["x"], by=["part"]))).collect()
    for a, b in zip(stored, fresh, strict=True):
        assert (a.n_rows, a.nulls) == (b.n_rows, b.nulls)
        exactly = {"x": 4500, "name": 300}[a.column_name]
        assert all(abs(r.distinct_estimate - exactly) <= math.ceil(exactly * sketches.DISTINCT_ERROR) for r in (a, b))


def test_frequent_values_within_bounds(spark):
    # 30,000 values of one row each, and some that make up a few per cent
    heavy = [("a", 3000), ("b", 2000), ("c", 1200)]
    df = spark.range(30_000).select(F.col("id").cast("string").alias("v"), (F.col("id") % 5).alias("p"))
    for v, n in heavy:
        df = df.unionByName(spark.range(n).select(F.lit(v).alias("v"), (F.col("id") % 5).alias("p")))
    total = 36_200
    found = sketches.report(sketches.merge(sketches.sketch(df, ["v"], by=["p"]))).first().frequent
    assert [f.item for f in found[:3]] == ["a", "b", "c"]
    for f, (_, n) in zip(found, heavy, strict=False):
        assert abs(f["count"] - n) <= sketches.FREQUENT_ERROR * total * 2  # the sketches of parts, then the merged one


def test_empty_table(spark):
    got = sketches.report(sketches.sketch(table(spark).where("false"), ["x", "name"], numeric=["x"])).collect()
    assert all(r.n_rows == 0 and r.distinct_estimate == 0 and r.quantiles is None and r.frequent == [] for r in got)


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_report_needs_one_scan_of_the_features(spark, scratch):
    catalog.Inputs(spark, SF_SMALL).consolidated.write.parquet(f"{scratch}/f")
    features = spark.read.parquet(f"{scratch}/f")
    assert scans(jobs.congestion_tables(jobs.report_cells(features))) == 1
    report = jobs.congestion_report(features)
    for table_, want in ((report.by_hour_bin, jobs.kpi_by_hour_bin(features)), (report.by_zone, jobs.kpi_by_zone(features)),
                         (report.by_zone_period, jobs.kpi_by_zone_period(features)), (report.correlations, kpi.correlations(features))):
        assert scans(table_) == 0  # they start from the written cells
        assert table_.columns == want.columns and sorted(map(str, table_.collect())) == sorted(map(str, want.collect()))


def test_merged_correlation_of_shifted_cells(spark):
    # cells whose means lie far apart: their own products alone would give another r
    rows = [(c, float(i + 1e5 * c), float(3 * i * (-1) ** c + 1e5 * c)) for c in range(4) for i in range(50)]
    df = spark.createDataFrame([*rows, (5, None, 1.0), (6, 2.0, None)], "c int, x double, y double")
    cells = kpi.moment_cells(df, ["c"], [], {"r": "x"}, "y")
    good = df.dropna()
    assert math.isclose(cells.agg(kpi.merged_correlation("r", None).alias("r")).first().r, good.corr("x", "y"), abs_tol=1e-9)
    constant = kpi.moment_cells(spark.createDataFrame([(0, 1.0, 2.0)] * 3, "c int, x double, y double"), ["c"], [], {"r": "x"}, "y")
    assert constant.agg(kpi.merged_correlation("r").alias("r")).first().r is None


def test_distinct_values_move_column_by_column(spark):
    df = table(spark, 3000).withColumn("x", F.when(F.col("id") < 1500, F.col("x")).otherwise(F.lit(float("nan"))))
    estimates = sketches.report(sketches.sketch(df, ["id", "x", "name", "none"]))
    made = sketches.checked(df, estimates)
    assert "Expand" not in made._jdf.queryExecution().executedPlan().toString()
    assert {r.column_name: r.n_distinct for r in made.collect()} == {"id": 3000, "x": 1351, "name": 300, "none": 0}
