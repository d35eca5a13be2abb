import math
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from urbanlens.operators import forest, model
from urbanlens.plans import catalog, jobs
from urbanlens.sources import sinks, versions

from .conftest import SF_SMALL


def plain(nodes, x):
    """Follow each tree by hand."""
    trees = {}
    for n in nodes:
        trees.setdefault(n.tree, {})[n.node] = n
    total = 0.0
    for t in trees.values():
        n = t[0]
        while not n.leaf:
            v = x[n.feature]
            if v is None or math.isnan(v):
                below = False
            else:
                below = v <= n.threshold if n.categories is None else v in n.categories
            n = t[n.below if below else n.above]
        total += n.prediction
    return total / len(trees)


def grown(rnd, trees, features, deep):
    out = []
    for t in range(trees):
        number = 0

        def grow(d):
            nonlocal number
            me, number = number, number + 1
            if d == 0 or rnd.random() < 0.2:
                out.append(forest.Node(t, me, rnd.uniform(-5, 5)))
                return me
            below, above = grow(d - 1), grow(d - 1)
            feature = rnd.randrange(features)
            split = {"threshold": rnd.uniform(-1, 1)} if feature % 2 else {"categories": tuple(float(x) for x in rnd.sample(range(4), rnd.randrange(4)))}
            out.append(forest.Node(t, me, 0.0, feature=feature, below=below, above=above, **split))
            return me

        grow(deep)
    return out


def test_expressions_follow_the_trees(spark):
    rnd = random.Random(4)
    nodes = grown(rnd, 5, 4, 4)
    rows = [tuple(rnd.choice([float(rnd.randrange(4)), rnd.uniform(-1, 1), None, float("nan")]) for _ in range(4)) for _ in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    inputs = [F.col(c) for c in "abcd"]
    got = df.select("*", forest.prediction(nodes, inputs).alias("p"), forest.prediction_by_lookup(nodes, F.array(*inputs)).alias("q")).collect()
    for r in got:
        want = plain(nodes, tuple(r)[:4])
        assert math.isclose(r.p, want, abs_tol=1e-9) and math.isclose(r.q, want, abs_tol=1e-9)
    # the table keeps everything
    assert forest.from_frame(forest.to_frame(spark, nodes)) == sorted(nodes, key=lambda n: (n.tree, n.node))


def test_broken_trees_are_errors():
    leaf = forest.Node(0, 1, 1.0)
    for nodes in ([leaf], [forest.Node(0, 0, 0.0, 0, 1.0, None, 1, 2), leaf], [forest.Node(0, 0, 1.0), forest.Node(0, 0, 2.0)],
                  [forest.Node(0, 0, 1.0), leaf], [forest.Node(0, 0, 0.0, 0, None, None, 1, 1), leaf]):
        with pytest.raises(ValueError):
            forest.check(nodes)
    with pytest.raises(ValueError):
        forest.prediction([], [])


def test_node_table_of_a_fitted_model_scores_like_the_model(spark, scratch):
    features = catalog.Inputs(spark, SF_SMALL).consolidated
    frame = model.model_frame(features)
    fitted = model.feature_pipeline(numTrees=6, maxDepth=5).fit(frame)
    sinks.save_model(fitted, f"{scratch}/model")
    table = forest.node_table(spark, f"{scratch}/model")
    nodes = forest.from_frame(table)
    assert {n.tree for n in nodes} == set(range(6)) and forest.depth(nodes) <= 5
    assert any(n.categories is not None for n in nodes) and any(n.threshold is not None for n in nodes)
    wide = vector_to_array("features")
    scored = fitted.transform(frame).withColumn("x", wide).select(
        "prediction", forest.prediction(nodes, [F.col("x")[i] for i in range(20)]).alias("p"), forest.prediction_by_lookup(nodes, F.col("x")).alias("q"))
    off = scored.agg(F.max(F.abs(F.col("prediction") - F.col("p"))), F.max(F.abs(F.col("prediction") - F.col("q"))), F.count(F.lit(1))).first()
    assert off[0] < 1e-9 and off[1] < 1e-9 and off[2] > 0


def test_the_model_is_fitted_once_per_input(spark, scratch):
    calls = []
    inputs = {"orders": f"{SF_SMALL}/orders.parquet"}

    def features():
        calls.append(1)
        return catalog.Inputs(spark, SF_SMALL).consolidated

    first = jobs.stored_fare_model(spark, features, f"{scratch}/m", inputs, numTrees=3, maxDepth=3)
    assert jobs.stored_fare_model(spark, features, f"{scratch}/m", inputs, numTrees=3, maxDepth=3) == first and len(calls) == 1
    assert jobs.stored_fare_model(spark, features, f"{scratch}/m", inputs, numTrees=2, maxDepth=3) != first and len(calls) == 2
    stored = jobs.read_fare_model(spark, first)
    assert {r.metric for r in stored.metrics.collect()} == {"rmse", "r2", "mae"} and stored.predictions.count() > 0
    assert len(versions.history(spark, f"{scratch}/m")) == 2


def test_lean_fit_grows_the_trees_of_spark_whatever_is_kept(spark, monkeypatch):
    """Rows drawn anew by each pass, or kept: the same draws, splits and predictions; nothing stays behind."""
    rnd = random.Random(11)
    rows = [[rnd.uniform(0, 9) for _ in model.NUMERIC_FEATURES] + [rnd.choice("abc") for _ in model.CATEGORICAL_FEATURES] + [rnd.uniform(3, 90)] for _ in range(400)]
    names = [*model.NUMERIC_FEATURES, *model.CATEGORICAL_FEATURES, model.TARGET]
    frame = spark.createDataFrame(rows, names).repartition(3, "trip_distance")
    few = dict(numTrees=6, maxDepth=4)
    stages = model.feature_pipeline(**few).getStages()
    own = Pipeline(stages=[*stages[:2], RandomForestRegressor(featuresCol="features", labelCol=model.TARGET, **{**model.FOREST_PARAMS, **few})])
    told = lambda fitted: fitted.stages[-1].toDebugString.split("\n", 1)[1]
    want = told(own.fit(frame))
    assert model.kept_in_memory(400, 20, 6, 0) == (False, False) and model.kept_in_memory(400, 20, 6, 1 << 30) == (True, True)
    held = spark.sparkContext._jsc.sc().getPersistentRDDs().size
    before = held()
    for memory in (0, 400 * 350, 1 << 30):
        monkeypatch.setattr(model, "storage_memory", lambda _, memory=memory: memory)
        assert told(model.feature_pipeline(**few).fit(frame)) == want and held() == before
    # more partitions than the tasks of a pass: every row is in some sum
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", 1)
    monkeypatch.setattr(model.LeanForestRegressor, "TASKS", 2)
    fitted = model.feature_pipeline(**few, bootstrap=False, featureSubsetStrategy="all").fit(frame)
    assert all(t._call_java("rootNode").impurityStats().count() == 400 for t in fitted.stages[-1].trees)
