import math
import os

from pyspark.ml import PipelineModel

from urbanlens.operators import model, text
from urbanlens.plans import catalog, jobs
from urbanlens.sources import sinks

from .conftest import SF_SMALL


def small_features(spark):
    return catalog.Inputs(spark, SF_SMALL).consolidated


def test_fare_model_invariants(spark, scratch):
    feats = small_features(spark)
    fm = jobs.fare_model(spark, feats, numTrees=5, maxDepth=4)
    metrics = {r.metric: r.value for r in fm.metrics.collect()}
    assert set(metrics) == {"rmse", "r2", "mae"} and metrics["rmse"] >= metrics["mae"] >= 0
    imps = fm.importance.collect()
    assert len(imps) == len(model.NUMERIC_FEATURES) + len(model.CATEGORICAL_FEATURES)
    assert math.isclose(sum(r.importance for r in imps), 1.0, abs_tol=1e-9)
    assert [r.importance for r in imps] == sorted((r.importance for r in imps), reverse=True)
    # refit on the same input is identical (seeded forest, md5 split)
    again = jobs.fare_model(spark, feats, numTrees=5, maxDepth=4)
    assert [r.importance for r in again.importance.collect()] == [r.importance for r in imps]
    assert fm.scored_by_hour_bin.count() >= 1 and "avg_velocity" in fm.scored_by_hour_bin.columns
    path = os.path.join(scratch, "model")
    sinks.save_model(fm.model, path)
    loaded = PipelineModel.load(path)
    assert loaded.transform(fm.predictions.drop("prediction", "features", *[c for c in fm.predictions.columns if c.endswith("_idx")])).count() == fm.predictions.count()


def test_fit_keeps_node_numbers_and_finds_the_same_trees(spark):
    rows = [(i, float(i % 37), float(i * 7 % 101), "abc"[i % 3], float(i % 37 * 2 + i * 7 % 101 + i % 3)) for i in range(3000)]
    frame = spark.createDataFrame(rows, "id int, x double, y double, kind string, fare double").coalesce(2)
    pipeline = model.feature_pipeline(["x", "y"], ["kind"], "fare", numTrees=7, maxDepth=8)
    forest = pipeline.getStages()[-1]
    assert forest.getCacheNodeIds() and forest.getCheckpointInterval() == -1
    kept = pipeline.fit(frame).stages[-1].toDebugString
    forest.setCacheNodeIds(False)
    strip = lambda text: text.split("\n", 1)[1]  # noqa: E731  (the first line has the model's own name)
    assert strip(pipeline.fit(frame).stages[-1].toDebugString) == strip(kept)


def test_unseen_category_gets_extra_index(spark):
    from pyspark.sql import functions as F

    feats = small_features(spark)
    frame = model.model_frame(feats)
    fitted = model.feature_pipeline(numTrees=2, maxDepth=2).fit(frame)
    odd = frame.limit(3).withColumn("payment_type", F.lit("never-seen"))
    assert fitted.transform(odd).count() == 3


def test_embed_text_unit_vectors(spark):
    df = spark.createDataFrame([(1, "Toy Story (1995)", "Animation|Children's|Comedy"), (2, "Heat (1995)", "Action|Crime")],
                               "item_id long, title string, genres string")
    out = text.embed_text(text.with_item_text(df), dim=16).collect()
    assert len(out) == 2
    for r in out:
        assert len(r.embedding) == 16
        n = math.sqrt(sum(x * x for x in r.embedding))
        assert math.isclose(n, 1.0, abs_tol=1e-9) or n == 0.0
