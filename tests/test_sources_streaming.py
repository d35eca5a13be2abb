import os

from pyspark.sql import functions as F

from urbanlens import cut_lineage
from urbanlens.plans import jobs
from urbanlens.sources import readers, sinks, testdata
from urbanlens.streaming import start_clean_trips

from .conftest import SF_SMALL, rows


def test_read_delimited_latin1(spark, scratch):
    path = os.path.join(scratch, "movies.dat")
    with open(path, "wb") as f:
        f.write("1::Amélie (2001)::Comedy|Romance\n2::Heat (1995)::Action|Crime|Thriller\n".encode("latin-1"))
    m = readers.load_movies(spark, path).collect()
    assert m[0].title == "Amélie (2001)" and m[1].genres == "Action|Crime|Thriller"
    rpath = os.path.join(scratch, "ratings.dat")
    with open(rpath, "w") as f:
        f.write("1::1::5::978300760\n1::2::3::978302109\n")
    r = readers.load_ratings(spark, rpath)
    assert rows(r) == [(1, 1, 5, 978300760), (1, 2, 3, 978302109)]


def test_read_lookup_marks_placeholders_null(spark, scratch):
    path = os.path.join(scratch, "zones.csv")
    with open(path, "w") as f:
        f.write('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n'
                '264,"Unknown","N/A","N/A"\n265,"N/A","Outside of NYC","N/A"\n')
    got = {r.LocationID: r.Boro_Name for r in readers.read_lookup(spark, path).collect()}
    assert got == {1: "EWR", 264: None, 265: None}


def test_state_partitions_roundtrip(spark, scratch):
    path = os.path.join(scratch, "state")
    a = spark.createDataFrame([(0, 1, [1.0, 0.0]), (1, 1, [0.0, 1.0])], "iteration int, user_id long, embedding array<double>")
    sinks.write_state(a, path)
    # recomputing iteration 1 alone replaces only that partition
    sinks.write_state(spark.createDataFrame([(1, 2, [0.5, 0.5])], a.schema), path)
    assert {"iteration=0", "iteration=1"} <= set(os.listdir(path))
    it1 = readers.read_state(spark, path, 1)
    assert [(r.user_id, r.embedding) for r in it1.collect()] == [(2, [0.5, 0.5])]
    assert readers.read_state(spark, path, 0).count() == 1
    assert "PartitionFilters" in it1._jdf.queryExecution().executedPlan().toString()


def test_report_csv_vectors_json_and_write_once(spark, scratch):
    df = spark.createDataFrame([("Morning_Rush", 10, 1.5)], "Hour_Bin string, trip_count long, avg_fare double")
    p = os.path.join(scratch, "report")
    sinks.write_report_csv(df, p)
    assert len([f for f in os.listdir(p) if f.endswith(".csv")]) == 1
    back = readers.read_report_csv(spark, p, df.schema)
    assert rows(back) == rows(df)
    v = os.path.join(scratch, "vectors")
    vec = spark.createDataFrame([(1, [0.5, 0.25])], "item_id long, embedding array<float>")
    sinks.write_vectors(vec, v)
    assert readers.read_vectors(spark, v).collect()[0].embedding == [0.5, 0.25]
    once = os.path.join(scratch, "once")
    assert sinks.write_once(spark, lambda: df, once)
    assert not sinks.write_once(spark, lambda: 1 / 0, once)  # kept, not even built
    assert spark.read.parquet(once).collect()[0].trip_count == 10
    sinks.write_once(spark, lambda: df.withColumn("trip_count", F.lit(99).cast("long")), once, force=True)
    assert spark.read.parquet(once).collect()[0].trip_count == 99
    j = os.path.join(scratch, "docs")
    docs = spark.createDataFrame([("cold", ["a", "b"], 0, "t:1")], "User_Type string, Recommendations array<string>, iteration int, generated_at string")
    sinks.write_recommendations_json(docs, j)
    sinks.write_recommendations_json(docs.withColumn("generated_at", F.lit("t:2")), j)  # the first run stays
    sinks.write_recommendations_json(docs, j)  # a rerun replaces its own
    assert sorted(os.listdir(os.path.join(j, "iteration=0"))) == ["run=t-1", "run=t-2"]
    assert [r.Recommendations for r in spark.read.json(j).collect()] == [["a", "b"]] * 2


def test_cut_lineage_uses_checkpoint_dir(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    out = cut_lineage(df)
    assert out.count() == 10
    assert spark.conf.get("spark.checkpoint.dir")


def test_stream_cleaning_equals_batch(spark, scratch):
    raw = testdata.trips(spark, SF_SMALL)
    files = os.path.join(scratch, "trips_files")
    # two "monthly" drops arriving in the same folder
    early = F.col("tpep_pickup_datetime") < F.lit("1998-01-01").cast("timestamp_ntz")
    raw.filter(early).write.mode("append").parquet(files)
    raw.filter(~early).write.mode("append").parquet(files)
    sink = os.path.join(scratch, "trips_clean")
    q = start_clean_trips(spark, files, raw.schema, sink, os.path.join(scratch, "ckpt"))
    q.awaitTermination(300)
    streamed = spark.read.parquet(sink)
    batch = jobs.clean_trips(raw)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0
