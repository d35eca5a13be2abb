import os

from pyspark.sql import functions as F

from urbanlens.functions import malformed_numeric, nullify_sentinels, parse_int
from urbanlens.operators import kpi, profile, quality
from urbanlens.operators.inspection import cells, inspect
from urbanlens.plans import jobs, run
from urbanlens.sources import testdata

from .conftest import SF_SMALL


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_reports_from_cells_equal_reports_from_rows(spark, scratch):
    testdata.sensors(spark, SF_SMALL).withColumn("Vol", F.when(F.col("MM") % 7 > 0, F.col("Vol"))).write.parquet(f"{scratch}/s")
    s = spark.read.parquet(f"{scratch}/s")
    rules = {**jobs.sensor_rules(), "malformed_volume": malformed_numeric("Vol"), "zero_text": F.col("Vol") == "0"}
    volume = nullify_sentinels(parse_int("Vol"))
    keys = ["SegmentID", "Boro", "Yr", "HH"]
    assert scans(cells(s, keys, rules, {"v": volume})) == 1
    found = inspect(s, keys, rules, {"v": volume})
    assert scans(found.describe()) == scans(found.coverage("SegmentID")) == 0
    same(found.table_report(), quality.table_report(s))
    same(found.nulls(), quality.null_counts_long(s))
    same(found.broken_rules(), quality.rule_counts(s, rules))
    same(found.describe(digits=8), quality.describe(s.select(volume.alias("v")), ["v"], digits=8))
    same(found.distinct("SegmentID"), quality.count_distinct(s, ["SegmentID"]))
    same(found.coverage("SegmentID"), profile.coverage(s, "SegmentID"))
    same(kpi.bottom_n(found.key_counts("SegmentID"), "n_rows", 5, ["SegmentID"]), kpi.bottom_n(profile.key_counts(s, "SegmentID"), "n_rows", 5, ["SegmentID"]))
    same(found.frequency("Boro"), quality.frequency(s, "Boro"))
    same(found.frequency("HH", rule="zero_text", by_count=False), quality.frequency(s.where("Vol = '0'"), "HH", order="key"))


def test_empty_and_one_row_tables(spark):
    df = spark.createDataFrame([(1, None)], "k int, x double")
    for rows in (df, df.where("false")):
        found = inspect(rows, ["k"], {"big": F.col("x") > 1}, ["x"])
        n = rows.count()
        assert {r.row_count for r in found.table_report().collect()} == {n}
        assert {r.column_name: r.null_count for r in found.nulls().collect()} == {"k": 0, "x": n}
        assert found.broken_rules().first().big == 0
        assert {r.statistic: r.x for r in found.describe().collect()} == {"count": 0.0, "mean": None, "stddev": None, "min": None, "max": None}
    one = inspect(spark.createDataFrame([(1, 2.5)], "k int, x double"), ["k"], described=["x"])
    assert {r.statistic: r.x for r in one.describe().collect()} == {"count": 1.0, "mean": 2.5, "stddev": None, "min": 2.5, "max": 2.5}


def test_quality_report_writes_all_tables(spark, scratch):
    testdata.trips(spark, SF_SMALL).write.parquet(f"{scratch}/t")
    run.run_quality_report(spark, f"{scratch}/t", None, f"{scratch}/q")
    assert {"trip_table", "trip_nulls", "trip_rules", "trip_describe"} <= set(os.listdir(f"{scratch}/q"))
    t = spark.read.parquet(f"{scratch}/t")
    got = spark.read.option("header", True).csv(f"{scratch}/q/trip_rules").first().asDict()
    assert {k: int(v) for k, v in got.items()} == quality.rule_counts(t, jobs.trip_rules()).first().asDict()


def test_versioned_item_vectors_follow_the_catalogue(spark, scratch):
    def write(lines):
        with open(f"{scratch}/m.dat", "w", encoding="latin-1") as f:
            f.write("\n".join(lines) + "\n")

    write(["1::Red apple::Fruit", "2::Green pear::Fruit"])
    first = run.run_versioned_item_vectors(spark, f"{scratch}/m.dat", f"{scratch}/v", dim=16, rank=2)
    assert run.run_versioned_item_vectors(spark, f"{scratch}/m.dat", f"{scratch}/v", dim=16, rank=2) == first
    write(["1::Red apple::Fruit", "2::Green pear::Fruit", "3::Steel engine::Motor"])
    second = run.run_versioned_item_vectors(spark, f"{scratch}/m.dat", f"{scratch}/v", dim=16, rank=2)
    assert second != first and spark.read.parquet(f"{second}/vectors").count() == 3 and spark.read.parquet(f"{first}/catalogue").count() == 2
