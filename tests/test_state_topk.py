import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanlens.operators import factors, recsys, state, text, topk

DAY = 86_400
SLICES = recsys.Slices(dt.date(1970, 1, 1), (dt.date(1970, 1, 10), dt.date(1970, 1, 20), None))


def ratings(spark, n=600):
    rnd = np.random.default_rng(3)
    rows = [(int(rnd.integers(20)), int(rnd.integers(30)), int(rnd.integers(1, 6)), int(rnd.integers(0, 30)) * DAY) for _ in range(n)]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating int, ts long")


def vectors(spark, n=28, width=5, seed=1):
    rnd = np.random.default_rng(seed)
    return spark.createDataFrame([(i, [float(x) for x in rnd.normal(size=width)]) for i in range(n)], "item_id long, embedding array<double>")


def test_states_step_by_step_equal_a_full_rebuild(spark, scratch):
    r, v = ratings(spark), vectors(spark)
    state.write_segments(r, SLICES, f"{scratch}/r")
    for i in range(SLICES.n):
        state.advance(spark, f"{scratch}/r", v, f"{scratch}/s", i)
    got = {(x.iteration, x.user_id): x for x in state.taste_of(spark.read.parquet(f"{scratch}/s")).collect()}
    want = {(x.iteration, x.user_id): x for x in recsys.taste_vectors(r, v, SLICES).collect()}
    assert got.keys() == want.keys()
    for k, x in want.items():
        assert got[k].n_vectors == x.n_vectors and np.allclose(got[k].embedding, x.embedding, atol=1e-12)
    # one iteration alone, again: the same state, the others untouched
    before = sorted(map(str, spark.read.parquet(f"{scratch}/s").collect()))
    state.advance(spark, f"{scratch}/r", v, f"{scratch}/s", 1)
    assert sorted(map(str, spark.read.parquet(f"{scratch}/s").collect())) == before


def test_an_iteration_reads_only_its_new_partition(spark, scratch):
    state.write_segments(ratings(spark), SLICES, f"{scratch}/r")
    new = state.segment_ratings(spark, f"{scratch}/r", 1)
    assert {f.split("segment=")[1][0] for f in new.inputFiles()} == {"0", "1", "2"}  # before pruning
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(segment" in plan and "(segment" in plan.split("PartitionFilters")[1].split("]")[0]
    assert {r.segment for r in new.select("segment").distinct().collect()} == {1}


def test_new_segment_leaves_others(spark, scratch):
    r = ratings(spark)
    state.write_segments(r, SLICES, f"{scratch}/r")
    whole = spark.read.parquet(f"{scratch}/r").count()
    last = recsys.assign_segment(r, SLICES).where("segment = 2").drop("segment")
    state.write_segments(last, SLICES, f"{scratch}/r")
    assert spark.read.parquet(f"{scratch}/r").count() == whole


def test_sums_of_different_widths_are_an_error(spark):
    a = spark.createDataFrame([(1, 2, [1.0, 2.0])], "user_id long, n_vectors long, total array<double>")
    b = spark.createDataFrame([(1, 1, [1.0]), (2, 1, [5.0])], "user_id long, n_vectors long, total array<double>")
    with pytest.raises(Exception, match="different widths"):
        state.merge_sums(a, b).collect()
    ok = {r.user_id: (r.n_vectors, r.total) for r in state.merge_sums(a, b.where("user_id = 2")).collect()}
    assert ok == {1: (2, [1.0, 2.0]), 2: (1, [5.0])}


def plain_top(users, items, seen, k):
    out = {}
    for key, u in users.items():
        nu = np.linalg.norm(u)
        scored = []
        for i, v in items.items():
            if (key, i) not in seen:
                nv = np.linalg.norm(v)
                scored.append((-(float(np.dot(u, v)) / (nu * nv) if nu and nv else 0.0), i))
        out[key] = [i for _, i in sorted((round(s, 12), i) for s, i in scored)[:k]]
    return out


@pytest.mark.parametrize("page,pivots", [(8, 5), (1024, 128), (3, 1)])
def test_top_items_equal_all_products(spark, page, pivots):
    rnd = np.random.default_rng(page)
    items = {i: rnd.normal(size=4) + 3 * np.eye(4)[i % 4] for i in range(120)}
    items[200] = np.zeros(4)
    items |= {300 + i: items[7] for i in range(12)}  # equal vectors: ties to the smaller id
    users = {(u % 2, u): rnd.normal(size=4) + np.eye(4)[u % 4] for u in range(40)} | {(0, 99): np.zeros(4), (1, 98): items[7]}
    seen = {(k, int(i)) for k in users for i in rnd.integers(0, 120, 25)} | {((0, 0), 9999)}
    u = spark.createDataFrame([(a, b, [float(x) for x in v]) for (a, b), v in users.items()], "iteration int, user_id long, embedding array<double>")
    i = spark.createDataFrame([(n, [float(x) for x in v]) for n, v in items.items()], "item_id long, embedding array<double>")
    s = spark.createDataFrame([(a, b, n) for (a, b), n in seen], "iteration int, user_id long, item_id long")
    got = {}
    for r in topk.top_items(u, i, 5, s, page, pivots).orderBy("rank").collect():
        got.setdefault((r.iteration, r.user_id), []).append(r.item_id)
    assert got == plain_top(users, items, seen, 5)


def test_top_items_of_few_or_none(spark):
    u = spark.createDataFrame([(1, [1.0, 0.0])], "user_id long, embedding array<double>")
    v = vectors(spark, 3, 2)
    assert topk.top_items(u, v, 5).count() == 3
    assert topk.top_items(u, v.where("false"), 5).count() == 0
    assert topk.top_items(u.where("false"), v, 5).count() == 0
    everything = v.select(F.lit(1).cast("long").alias("user_id"), "item_id")
    assert topk.top_items(u, v, 5, everything).count() == 0


def test_score_items_refuses_two_users_of_an_iteration(spark):
    two = spark.createDataFrame([(0, 1, [1.0] * 5), (0, 2, [1.0] * 5)], "iteration int, user_id long, embedding array<double>")
    with pytest.raises(Exception, match="one user per iteration"):
        recsys.score_items(two, vectors(spark), SLICES).collect()


def cells(spark, x):
    rows = [(i, [(int(j), float(x[i, j])) for j in np.flatnonzero(x[i])]) for i in range(len(x))]
    return spark.createDataFrame(rows, "item_id long, cells array<struct<at:int,w:double>>")


def test_gram_and_factors_equal_numpy(spark):
    rnd = np.random.default_rng(8)
    x = rnd.normal(size=(90, 4)) @ rnd.normal(size=(4, 16)) + 0.01 * rnd.normal(size=(90, 16))
    x[rnd.random(x.shape) < 0.3] = 0
    df = cells(spark, x).repartition(5)
    g = np.zeros((16, 16))
    for r in factors.gram(df, 16).collect():
        g[r["at"]] = r["products"]
    assert np.allclose(g, x.T @ x)
    values, right = factors.leading(x.T @ x, 6)
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(values, s[:6], rtol=1e-6) and np.allclose(np.abs((right * vt[:6].T).sum(axis=0)), 1, atol=1e-6)
    got = np.array([r.embedding for r in factors.latent_factors(df, 16, 6).orderBy("item_id").collect()])
    assert np.allclose(np.abs(got), np.abs(x @ vt[:6].T), atol=1e-4)
    again = np.array([r.embedding for r in factors.latent_factors(df.repartition(3), 16, 6).orderBy("item_id").collect()])
    assert np.allclose(got, again, atol=1e-9)  # signs too


def test_latent_text_brings_related_words_together(spark):
    rows = [(1, "red apple fruit"), (2, "green pear fruit"), (3, "red cherry fruit"), (4, "steel engine motor"), (5, "diesel motor car"), (6, "engine car wheel"), (7, ""), (8, None)]
    df = spark.createDataFrame(rows, "item_id long, text string")
    got = {r.item_id: np.array(r.embedding) for r in text.latent_text(df, dim=64, rank=2).collect()}
    assert len(got) == 8 and not got[7].any() and not got[8].any()
    assert got[1] @ got[2] > 0.9 and got[4] @ got[5] > 0.9 and abs(got[1] @ got[4]) < 0.5
    with pytest.raises(ValueError):
        factors.gram(cells(spark, np.eye(2)), 10**6)


@pytest.mark.parametrize("direct", [0, 64])
def test_users_move_a_bounded_number_of_times(spark, direct):
    """Each user meets many pages, but its vector is not copied to each of them."""
    rnd = np.random.default_rng(11)
    n, width = 300, 64
    u = spark.createDataFrame([(i, [float(x) for x in rnd.normal(size=width)]) for i in range(n)], "user_id long, embedding array<double>").repartition(3)
    items = {i: rnd.normal(size=width) for i in range(200)}
    v = spark.createDataFrame([(i, [float(y) for y in x]) for i, x in items.items()], "item_id long, embedding array<double>")
    seen = {(int(a), int(b)) for a, b in rnd.integers(0, 200, (600, 2))}
    hidden = spark.createDataFrame(sorted(seen), "user_id long, item_id long")
    scan, topk.USERS = topk._meet, 64

    def counted(*args):
        run = scan(*args)

        def spy(batches):
            def seen():
                for b in batches:
                    total.add(sum(x == 0 for x in b.column("kind").to_pylist()))
                    yield b

            yield from run(seen())

        return spy

    total = spark.sparkContext.accumulator(0)
    topk._meet = counted
    try:
        met = topk.top_items(u, v, 5, lambda keys: hidden.join(keys, "user_id", "left_semi"), page=10, pivots=4, direct=direct).orderBy("user_id", "rank").collect()
    finally:
        topk._meet, topk.USERS = scan, 8192
    assert total.value <= 2 * n
    users = {r.user_id: np.array(r.embedding) for r in u.collect()}
    got = {}
    for r in met:
        got.setdefault(r.user_id, []).append(r.item_id)
    assert got == plain_top(users, items, seen, 5)


def test_wide_vectors_are_not_broadcast(spark):
    x = cells(spark, np.eye(4))
    for found in (factors.latent_factors(x, 4, 2), text.latent_text(spark.createDataFrame([(1, "a b"), (2, "b c")], "item_id long, text string"), dim=8, rank=2)):
        plan = x.select("item_id").join(found, "item_id", "left")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan.split("SortMergeJoin")[0]
