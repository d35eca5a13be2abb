import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from urbanlens.operators import profile
from urbanlens.operators.selection import select_quantiles

FRACTIONS = (0.1, 0.25, 0.5, 0.9, 1.0)


def plain(rows, fractions):
    groups = {}
    for k, v in rows:
        groups.setdefault(k, []).append(v)
    out = {}
    for k, values in groups.items():
        known = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
        for q in fractions:
            out[k, q] = known[max(1, math.ceil(q * len(known))) - 1] if known else None
    return out


def selected(spark, rows, fractions=FRACTIONS, **more):
    df = spark.createDataFrame(rows, "k string, v double")
    return {(r.k, r.fraction): r.value for r in select_quantiles(df, ["k"], "v", fractions, **more).collect()}


def test_all_distinct_doubles_equal_percentile_disc(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), rnd.lognormvariate(0, 40)) for _ in range(4000)]
    rounds = []
    assert selected(spark, rows, few=20, rounds=rounds) == plain(rows, FRACTIONS)
    assert 1 <= len(rounds) <= 4  # about 64-fold each


def test_heavy_values_and_ties_end(spark):
    rows = [("h", 5.0)] * 3000 + [("h", float(i)) for i in range(400)] + [("two", float(i % 2)) for i in range(999)] + [("n", None)] * 5 + [("i", float("inf"))] * 50 + [("i", -float("inf"))] * 49
    assert selected(spark, rows, few=3) == plain(rows, FRACTIONS)


def test_against_the_engine_on_many_groups(spark):
    df = spark.range(30_000).select((F.col("id") % 7).alias("k"), F.md5(F.col("id").cast("string")).alias("h")).withColumn("v", F.conv(F.substring("h", 1, 12), 16, 10).cast("double") / 1000)
    want = {r.k: r.m for r in df.groupBy("k").agg(F.expr("percentile_disc(0.5) within group (order by v)").alias("m")).collect()}
    assert {r.k: r.value for r in select_quantiles(df, ["k"], "v", few=200).collect()} == want


def test_no_keys_wrong_fractions_and_empty(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("v"))
    assert [r.value for r in select_quantiles(df, [], "v", few=5).collect()] == [49.0]
    assert select_quantiles(df.where("false").withColumn("k", F.lit("x")), ["k"], "v").count() == 0
    for q in (0.0, 1.5):
        with pytest.raises(ValueError):
            select_quantiles(df, [], "v", (q,))


def test_profile_by_selection_equals_exact(spark):
    rows = [(s, b, float(v)) for s in range(5) for b in ("x", None) for v in (3, 1, 2, 2, 9)]
    df = spark.createDataFrame(rows, "s int, b string, v double")
    both = [sorted(map(str, profile.median_profile(df, ["s", "b"], "v", method=m).collect())) for m in ("exact", "select")]
    assert both[0] == both[1]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.floats(allow_nan=False, width=64), st.sampled_from([0.0, 1.0, 1.0]))), min_size=1, max_size=60))
def test_any_values(spark, rows):
    assert selected(spark, [(k, v + 0.0 if v is not None else None) for k, v in rows], (0.25, 0.5), few=2) == plain(rows, (0.25, 0.5))


def test_rows_of_few_groups_are_read_once_and_stay_where_they_are(spark):
    """The source runs once, whatever the number of rounds, and no round sends a group's rows to one task."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def value(i):
        read.add(1)
        return float(i * 7919 % 30_011)

    df = spark.range(20_000).repartition(6).select((F.col("id") % 2).cast("string").alias("k"), value.asNondeterministic()("id").alias("v"))
    rounds = []
    made = select_quantiles(df, ["k"], "v", (0.5,), few=50, rounds=rounds)
    got = {r.k: r.value for r in made.collect()}
    rows = [(str(i % 2), float(i * 7919 % 30_011)) for i in range(20_000)]
    assert got == {k: v for (k, _), v in plain(rows, (0.5,)).items()} and len(rounds) >= 2
    assert read.value == 20_000
    assert "SortMergeJoin" not in made._jdf.queryExecution().executedPlan().toString()
