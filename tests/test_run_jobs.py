"""The whole workflow through the job entry points, on files derived from the
smallest driver tables (CSV sensors, '::' text ratings and catalogue)."""

import os

from pyspark.sql import functions as F

from urbanlens.operators import recsys
from urbanlens.plans import run
from urbanlens.sources import testdata

from .conftest import SF_SMALL


def _write_text(df, path, sep):
    lines = [sep.join("" if v is None else str(v) for v in r) for r in df.collect()]
    with open(path, "w", encoding="latin-1") as f:
        f.write("\n".join(lines) + "\n")


def test_workflow_end_to_end(spark, scratch):
    p = lambda *x: os.path.join(scratch, *x)
    testdata.trips(spark, SF_SMALL).write.parquet(p("raw_trips"))
    testdata.sensors(spark, SF_SMALL).coalesce(1).write.option("header", True).csv(p("sensors_csv"))
    testdata.zones(spark, SF_SMALL).select("LocationID", F.col("Boro_Name").alias("Borough"),
                                          F.lit("z").alias("Zone"), F.lit("s").alias("service_zone")) \
        .coalesce(1).write.option("header", True).csv(p("zones_csv"))

    counts = run.run_clean_trips(spark, p("raw_trips"), p("clean_trips")).collect()[0]
    assert counts.rows_after == spark.read.parquet(p("clean_trips")).count() > 0
    run.run_sensor_profile(spark, p("sensors_csv"), p("sensor_profile"))
    run.run_consolidate(spark, p("clean_trips"), p("sensor_profile"), p("zones_csv"), p("features"), p("audit"))
    feats = spark.read.parquet(p("features"))
    assert feats.count() > 0 and feats.filter(F.col("pickup_avg_median_volume").isNull()).count() == 0
    run.run_congestion_report(spark, p("features"), p("report"))
    assert spark.read.option("header", True).csv(p("report", "by_hour_bin")).count() >= 1
    run.run_fare_model(spark, p("features"), p("model"), p("model_reports"), numTrees=3, maxDepth=3)
    assert spark.read.option("header", True).csv(p("model_reports", "metrics")).count() == 3
    run.run_quality_report(spark, p("raw_trips"), p("sensors_csv"), p("quality"))
    assert os.path.isdir(p("quality", "segment_coverage"))
    run.run_chart_tables(spark, p("report"), p("charts"))
    assert spark.read.option("header", True).csv(p("charts", "by_hour_bin")).count() == 4

    _write_text(testdata.movies(spark, SF_SMALL), p("movies.dat"), "::")
    _write_text(testdata.ratings(spark, SF_SMALL), p("ratings.dat"), "::")
    run.run_item_vectors(spark, p("movies.dat"), p("vectors"), p("catalogue"), dim=32)
    slices = recsys.Slices(testdata.FIRST_DAY, testdata.LAST_DAYS)
    run.run_user_state(spark, p("ratings.dat"), p("vectors"), p("state"), slices)
    assert {"iteration=0", "iteration=3"} <= set(os.listdir(p("state")))
    run.run_recommendations(spark, p("ratings.dat"), p("vectors"), p("catalogue"), p("recs"), slices,
                            generated_at="2024-01-01T00:00:00Z")
    docs = spark.read.json(p("recs"))
    assert docs.count() == 2 * slices.n
    assert docs.filter(F.size("Recommendations") == 5).count() == 2 * slices.n
    # with the stored state the documents are the same (stored = recomputed vectors)
    run.run_recommendations(spark, p("ratings.dat"), p("vectors"), p("catalogue"), p("recs_state"), slices,
                            generated_at="2024-01-01T00:00:00Z", state_dir=p("state"))
    cols = ["iteration", "User_Type", "Num_Ratings", "Recommendations"]
    a = sorted(tuple(r) for r in docs.select(*cols).collect())
    b = sorted(tuple(r) for r in spark.read.json(p("recs_state")).select(*cols).collect())
    assert a == b


def test_cli_clean_trips(spark, scratch):
    import subprocess
    import sys

    src, dst = os.path.join(scratch, "raw"), os.path.join(scratch, "clean")
    testdata.trips(spark, SF_SMALL).write.parquet(src)
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "PYTHONPATH": repo}
    out = subprocess.run([sys.executable, "-m", "urbanlens.plans.run", "clean-trips", src, dst],
                         cwd=repo, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "rows_removed" in out.stdout
    assert spark.read.parquet(dst).count() == spark.read.parquet(src).filter(
        "fare_amount > 0 AND fare_amount <= 800 AND trip_distance > 0 AND trip_distance <= 100 "
        "AND passenger_count > 0").count()
