import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanlens.sources import drift, layout, quarantine, readers


# ---- schema drift
def months(spark, scratch):
    spark.createDataFrame([(1, 2, 10.5)], "trip_id long, passenger_count int, fare double").write.parquet(f"{scratch}/m/2024-01")
    spark.createDataFrame([(2, 3.0, 11), (3, None, 12)], "trip_id long, passenger_count double, fare int").write.parquet(f"{scratch}/m/2024-02")
    spark.createDataFrame([(4, 1, 5.0, "N", 0.75)], "trip_id int, Passenger_Count long, fare float, flag string, cbd_fee double").write.parquet(f"{scratch}/m/2025-01")
    return f"{scratch}/m"


def test_months_of_different_types_read_as_one(spark, scratch):
    got = drift.read_drifting(spark, months(spark, scratch), defaults={"flag": "N"})
    assert [(f.name, f.dataType.simpleString()) for f in got.schema.fields] == [
        ("trip_id", "bigint"), ("passenger_count", "double"), ("fare", "double"), ("flag", "string"), ("cbd_fee", "double")]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == [(1, 2.0, 10.5, "N", None), (2, 3.0, 11.0, "N", None), (3, None, 12.0, "N", None), (4, 1.0, 5.0, "N", 0.75)]
    some = drift.read_drifting(spark, months(spark, scratch + "/b"), columns=["FARE", "trip_id"])
    assert some.columns == ["trip_id", "fare"]


def test_filters_and_columns_reach_every_group(spark, scratch):
    df = drift.read_drifting(spark, months(spark, scratch)).where(F.col("fare") > 10.75).select("trip_id", "fare")
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 3 and all("passenger" not in line.lower().split("readschema")[1] for line in scans)
    assert all("GreaterThan(fare" in line or "GreaterThanOrEqual(fare" in line or "LessThan" in line for line in scans), scans
    assert sorted(r.trip_id for r in df.collect()) == [2, 3]


def test_types_without_a_common_one_are_errors(spark, scratch):
    assert drift.wider(T.IntegerType(), T.FloatType()) == T.DoubleType() and drift.wider(T.DecimalType(5, 2), T.DecimalType(9, 0)) == T.DecimalType(11, 2)
    assert drift.wider(T.NullType(), T.StringType()) == T.StringType() and drift.wider(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType()
    for a, b in ((T.StringType(), T.IntegerType()), (T.DecimalType(38, 0), T.DecimalType(38, 38)), (T.BooleanType(), T.DoubleType())):
        with pytest.raises(ValueError):
            drift.wider(a, b)
    spark.createDataFrame([("x",)], "fare string").write.parquet(f"{scratch}/a/1")
    spark.createDataFrame([(1,)], "fare int").write.parquet(f"{scratch}/a/2")
    with pytest.raises(ValueError, match="column fare"):
        drift.read_drifting(spark, f"{scratch}/a")
    os.makedirs(f"{scratch}/none")
    with pytest.raises(ValueError, match="no Parquet files"):
        drift.read_drifting(spark, f"{scratch}/none")


# ---- quarantine
LINES = ["SegmentID,Boro,street,Yr,M,D,HH,MM,Vol", "1,Queens,A,2024,1,2,3,4,17", '2,"Bro,nx",B,2024,1,2,3,4,"1,234"', "3,Queens,C,2024,1", "4,Queens,D,2024,1,2,3,4,5,extra",
         "x5,Queens,E,2024,1,2,3,4,5", "6,Queens,F,2024,1,2,3,4,", "7,,,,,,,,"]


def test_short_long_and_unparseable_rows_end_in_quarantine(spark, scratch):
    with open(f"{scratch}/s.csv", "w") as f:
        f.write("\n".join(LINES) + "\n")
    got = quarantine.load(spark, f"{scratch}/s.csv", readers.SENSOR_COUNTS_SCHEMA, f"{scratch}/out")
    assert (got.rows_good, got.rows_bad) == (4, 3)
    assert sorted((r.SegmentID, r.Boro, r.Vol) for r in got.good.collect()) == [(1, "Queens", "17"), (2, "Bro,nx", "1,234"), (6, "Queens", None), (7, None, None)]
    assert got.good.columns == readers.SENSOR_COUNTS_SCHEMA.fieldNames()
    assert {r.fault: r.record for r in got.bad.collect()} == {"short": LINES[3], "long": LINES[4], "value": LINES[5]}
    assert all(r.file.endswith("s.csv") for r in got.bad.collect())
    # the good rows are the same if few columns are read
    assert got.good.select("Boro").count() == 4


def test_too_many_bad_rows_are_an_error_and_stay_readable(spark, scratch):
    with open(f"{scratch}/s.csv", "w") as f:
        f.write("\n".join(LINES) + "\n")
    with pytest.raises(ValueError, match="3 of 7 rows"):
        quarantine.load(spark, f"{scratch}/s.csv", readers.SENSOR_COUNTS_SCHEMA, f"{scratch}/out", most_bad=0.1)
    assert spark.read.parquet(f"{scratch}/out/bad=true").count() == 3
    with open(f"{scratch}/e.csv", "w") as f:
        f.write(LINES[0] + "\n")
    empty = quarantine.load(spark, f"{scratch}/e.csv", readers.SENSOR_COUNTS_SCHEMA, f"{scratch}/empty", most_bad=0.0)
    assert (empty.rows_good, empty.rows_bad, empty.good.count(), empty.bad.count()) == (0, 0, 0, 0)


def test_double_colon_rows(spark, scratch):
    with open(f"{scratch}/r.dat", "w", encoding="latin-1") as f:
        f.write("1::10::5::978300760\n2::x::3::978302109\n3::4\né::1::1::1\n")
    got = quarantine.load(spark, f"{scratch}/r.dat", readers.RATINGS_SCHEMA, f"{scratch}/out", sep="::", header=False, encoding="ISO-8859-1")
    assert [tuple(r) for r in got.good.collect()] == [(1, 10, 5, 978300760)]
    assert sorted(r.fault for r in got.bad.collect()) == ["short", "value", "value"] and any("é" in r.record for r in got.bad.collect())


# ---- bucketed tables
def test_bucketed_tables_join_without_exchange(spark, scratch):
    names = [f"t{uuid.uuid4().hex[:10]}" for _ in range(3)]
    trips = spark.range(4000).select((F.col("id") % 1500).alias("trip_id"), (F.col("id") * 1.5).alias("fare")).unionByName(spark.createDataFrame([(None, 1.0)], "trip_id long, fare double"))
    scores = spark.range(1500).select(F.col("id").alias("trip_id"), (F.col("id") % 7).alias("score"))
    a = layout.write_bucketed(trips, names[0], f"{scratch}/a", "trip_id", 4)
    b = layout.write_bucketed(scores, names[1], f"{scratch}/b", "trip_id", 4)
    joined = layout.join_on_key(a, b, "trip_id")
    assert layout.exchanges(joined) == 0 and "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, joined.collect())) == sorted(map(str, trips.join(scores, "trip_id", "left").collect()))
    counts = layout.bucket_counts(a, "trip_id")
    assert layout.exchanges(counts) == 0 and counts.count() == 1501
    assert layout.exchanges(layout.bucket_counts(trips, "trip_id")) >= 1
    again = layout.attach(spark, names[2], f"{scratch}/a", "trip_id BIGINT, fare DOUBLE", "trip_id", 4)
    assert layout.exchanges(layout.join_on_key(again, b, "trip_id")) == 0 and again.count() == 4001
    for n in names:
        spark.sql(f"DROP TABLE {n}")


def test_number_of_buckets():
    assert [layout.buckets_for(x, 100) for x in (0, 100, 101, 1000)] == [1, 1, 2, 16]
