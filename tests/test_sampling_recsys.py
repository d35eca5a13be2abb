import datetime as dt
import hashlib
import math

import numpy as np
import pytest

from urbanlens.operators import recsys, sampling


def md5(s: str) -> str:
    return hashlib.md5(s.encode()).hexdigest()


def test_sample_keys_exact_size_matches_brute_force(spark):
    # enough keys that the boundary bucket is partial and other buckets are full
    data = [(g, k) for g in range(3) for k in range(g * 1000, g * 1000 + 700 + 300 * g)]
    df = spark.createDataFrame(data, "g int, k long")
    out = sampling.sample_keys(df, "k", 0.3, seed=42, groups=["g"], seed_offset="g")
    got = {}
    for r in out.collect():
        got.setdefault(r.g, set()).add(r.k)
    for g in range(3):
        keys = [k for gg, k in data if gg == g]
        want = sorted(keys, key=lambda k: (md5(f"{42 + g}:{k}"), k))[: max(1, int(len(keys) * 0.3))]
        assert got[g] == set(want)


def test_sample_keys_at_least_one(spark):
    df = spark.createDataFrame([(0, 5), (0, 6)], "g int, k long")
    out = sampling.sample_keys(df, "k", 0.1, groups=["g"])
    assert out.count() == 1


def test_pick_one_and_split(spark):
    df = spark.createDataFrame([(0, k) for k in range(50)] + [(1, k) for k in range(10)], "g int, k long")
    got = {r.g: r.k for r in sampling.pick_one(df, "k", 42, groups=["g"]).collect()}
    assert got[0] == min(range(50), key=lambda k: md5(f"42:{k}"))
    assert got[1] == min(range(10), key=lambda k: md5(f"42:{k}"))
    a, b = sampling.hash_split(df.select("k").distinct(), ["k"], 0.8, 42)
    sa, sb = {r.k for r in a.collect()}, {r.k for r in b.collect()}
    assert not sa & sb and len(sa | sb) == 50


DAY = 86400
SLICES = recsys.Slices(dt.date(1970, 1, 11), (dt.date(1970, 1, 21), dt.date(1970, 1, 31), None))


def ratings_fixture(spark):
    data = [
        # user, item, rating, ts
        (1, 100, 5, 10 * DAY),  # first second of the first day
        (1, 101, 4, 21 * DAY - 1),  # last second of the first slice
        (1, 102, 2, 21 * DAY),  # one second after: segment 1
        (2, 100, 4, 25 * DAY),
        (2, 103, 3, 40 * DAY),
        (3, 104, 5, 5 * DAY),  # before lo: never counted
        (3, 105, 4, 35 * DAY),  # item without a vector
        (4, 106, 4, 12 * DAY),
        (4, 107, 4, 12 * DAY),  # two liked vectors that cancel to zero
        (5, 100, 4, 15 * DAY),
        (5, 100, 5, 16 * DAY),  # duplicate rating of one item
        (5, 999, 5, 15 * DAY),  # item absent from the catalogue
    ]
    return spark.createDataFrame(data, "user_id long, item_id long, rating int, ts long")


def vectors_fixture(spark):
    vecs = {100: [1.0, 0.0, 0.0], 101: [0.0, 1.0, 0.0], 102: [0.0, 0.0, 1.0], 103: [1.0, 1.0, 0.0],
            104: [0.0, 1.0, 1.0], 106: [1.0, 2.0, 3.0], 107: [-1.0, -2.0, -3.0], 108: [0.5, 0.5, 0.5]}
    return spark.createDataFrame([(k, v) for k, v in vecs.items()], "item_id long, embedding array<float>"), vecs


def catalogue_fixture(spark):
    return spark.createDataFrame([(i, f"Title {i}", "Drama|Comedy") for i in range(100, 109)],
                                 "item_id long, title string, genres string")


def brute_taste(ratings, vecs, it):
    ends = (21 * DAY, 31 * DAY, None)
    out = {}
    users = {r[0] for r in ratings}
    for u in users:
        liked = [r[1] for r in ratings if r[0] == u and r[2] >= 4 and r[3] >= 10 * DAY
                 and (ends[it] is None or r[3] < ends[it])]
        vs = [np.array(vecs[m], dtype=float) for m in liked if m in vecs]
        if not vs:
            continue
        avg = np.mean(np.stack(vs), axis=0)
        n = np.linalg.norm(avg)
        out[u] = avg / n if n > 0 else avg
    return out


def test_segments_and_cumulative_rows(spark):
    r = ratings_fixture(spark)
    rows = recsys.expand_iterations(recsys.assign_segment(r, SLICES), SLICES).groupBy("iteration").count().collect()
    assert {x.iteration: x["count"] for x in rows} == {0: 7, 1: 9, 2: 11}
    new = {(x.iteration, x.user_id) for x in recsys.new_keys(r, SLICES).collect()}
    assert new == {(0, 1), (0, 4), (0, 5), (1, 2), (2, 3)}


def test_taste_vectors_match_numpy(spark):
    r = ratings_fixture(spark)
    v, vecs = vectors_fixture(spark)
    data = [tuple(x) for x in r.collect()]
    got = {(x.iteration, x.user_id): x.embedding for x in recsys.taste_vectors(r, v, SLICES).collect()}
    for it in range(SLICES.n):
        want = brute_taste(data, vecs, it)
        assert {u for (i, u) in got if i == it} == set(want)
        for u, vec in want.items():
            assert np.allclose(got[(it, u)], vec, atol=1e-12)
    assert got[(0, 4)] == [0.0, 0.0, 0.0]  # cancelling vectors stay zero
    assert (2, 3) not in got  # liked item has no vector -> absent


def test_popularity_ties_and_catalogue(spark):
    r = ratings_fixture(spark)
    cold = recsys.cold_recommendations(r, catalogue_fixture(spark), SLICES, n=2).collect()
    it0 = [(x.rank, x.item_id) for x in sorted(cold, key=lambda x: (x.iteration, x.rank)) if x.iteration == 0]
    # item 100 rated 3 times; 101/106/107 tie at 1 -> smallest id; 999 not in catalogue
    assert it0 == [(1, 100), (2, 101)]


def test_recommend_excludes_seen_and_plans_group_limit(spark):
    r = ratings_fixture(spark)
    v, vecs = vectors_fixture(spark)
    users = spark.createDataFrame([(0, 1), (1, 1), (2, 1)], "iteration int, user_id long")
    taste = recsys.taste_vectors(r, v, SLICES).join(users, ["iteration", "user_id"], "left_semi")
    scores = recsys.score_items(taste, v, SLICES)
    seen = recsys.seen_items(r, users, SLICES)
    rec = recsys.recommend(scores, seen, catalogue_fixture(spark), n=3)
    out = rec.collect()
    seen_rows = {(x.iteration, x.item_id) for x in seen.collect()}
    assert out and all((x.iteration, x.item_id) not in seen_rows for x in out)
    # brute force for iteration 0: user 1 liked 100 and 101 -> taste (1,1,0)/sqrt2
    t = np.array([1.0, 1.0, 0.0]) / math.sqrt(2)
    cand = {m: float(np.dot(t, vecs[m]) / (np.linalg.norm(t) * np.linalg.norm(vecs[m]))) for m in vecs if m not in (100, 101)}
    want = sorted(cand, key=lambda m: (-cand[m], m))[:3]
    got = [x.item_id for x in sorted(out, key=lambda x: x.rank) if x.iteration == 0]
    assert got == want
    plan = rec._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_fallback_when_top_user_has_no_vector(spark):
    # user 9 has many ratings but no liked item with a vector -> popularity list
    data = [(9, 105, 5, 11 * DAY), (9, 100, 2, 11 * DAY), (9, 101, 1, 12 * DAY), (8, 100, 5, 11 * DAY)]
    r = spark.createDataFrame(data, "user_id long, item_id long, rating int, ts long")
    v, _ = vectors_fixture(spark)
    out = recsys.recommendations_with_fallback(r, v, catalogue_fixture(spark), SLICES, n=2).collect()
    top = sorted((x.rank, x.item_id) for x in out if x.user_type == "top" and x.iteration == 0)
    cold = sorted((x.rank, x.item_id) for x in out if x.user_type == "cold" and x.iteration == 0)
    assert top == cold and len(cold) == 2


def test_user_stats_and_top_users(spark):
    r = ratings_fixture(spark)
    st = {(x.iteration, x.user_id): x for x in recsys.user_stats(r, SLICES).collect()}
    assert st[(1, 1)].num_ratings == 3 and st[(1, 1)].avg_rating == round(11 / 3, 2)
    assert st[(1, 1)].last_interaction_time == "1970-01-22 00:00:00"
    top = recsys.top_users(r, SLICES, 95).collect()
    for it in range(3):
        counts = [x.num_ratings for k, x in st.items() if k[0] == it]
        thr = float(np.percentile(counts, 95))
        assert {x.user_id for x in top if x.iteration == it} == {
            k[1] for k, x in st.items() if k[0] == it and x.num_ratings >= thr}


@pytest.mark.parametrize("n", [1, 3])
def test_documents_shape(spark, n):
    r = ratings_fixture(spark)
    v, _ = vectors_fixture(spark)
    docs = recsys.recommendation_documents(r, v, catalogue_fixture(spark), SLICES, "2024-01-01T00:00:00Z", n=n)
    out = docs.collect()
    assert len(out) == 2 * SLICES.n
    for d in out:
        assert len(d.Recommendations) <= n
        if d.User_Type == "cold":
            assert d.Num_Ratings == 0 and d.Avg_Rating is None
    assert dict(docs.dtypes)["Recommendations"] == "array<string>"


def test_stored_state_preferred_over_recompute(spark):
    r = ratings_fixture(spark)
    v, _ = vectors_fixture(spark)
    users = spark.createDataFrame([(0, 1), (1, 2)], "iteration int, user_id long")
    state = spark.createDataFrame([(0, 1, 7, [0.0, 0.0, 1.0])], "iteration int, user_id long, n_vectors long, embedding array<double>")
    got = {(x.iteration, x.user_id): (x.n_vectors, x.embedding) for x in recsys.user_vectors_for(r, v, SLICES, users, state).collect()}
    assert got[(0, 1)] == (7, [0.0, 0.0, 1.0])  # stored wins
    assert got[(1, 2)][0] == 1  # not stored: recomputed from user 2's one liked vector


def test_split_label_agrees_with_split(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    a, _ = sampling.hash_split(df, ["k"], 0.8, 42)
    labelled = {r.k for r in df.filter(sampling.hash_split_label(["k"], 0.8, 42) == "train").collect()}
    assert labelled == {r.k for r in a.collect()}


def test_top_user_lists_follow_the_vector_and_the_catalogue(spark):
    """A vector without a catalogue row is not listed, a user who has seen everything gets
    an empty list, and only a user without any vector gets the popular items."""
    slices = recsys.Slices(dt.date(1970, 1, 1), (None,))
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (99, [1.0, 0.1])], "item_id long, embedding array<float>")
    catalogue = spark.createDataFrame([(1, "A", "x"), (2, "B", "x"), (3, "C", "x")], "item_id long, title string, genres string")

    def top(rows):
        r = spark.createDataFrame([(7, i, s, 100) for i, s in rows], "user_id long, item_id long, rating int, ts long")
        docs = recsys.recommendation_documents(r, vectors, catalogue, slices, "t").collect()
        return {d.User_Type: d.Recommendations for d in docs}

    assert top([(1, 5)])["top"] == ["B"]  # 99 has no title
    assert top([(1, 5), (2, 5), (99, 1)])["top"] == []  # everything seen
    assert top([(3, 5)])["top"] == ["C"]  # no vector: popularity


def test_vectors_of_different_widths_are_an_error(spark):
    slices = recsys.Slices(dt.date(1970, 1, 1), (None,))
    r = spark.createDataFrame([(7, 1, 5, 100), (7, 2, 5, 100)], "user_id long, item_id long, rating int, ts long")
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0, 1.0])], "item_id long, embedding array<float>")
    with pytest.raises(Exception, match="[Dd]imension|width|size"):
        recsys.taste_vectors(r, vectors, slices).collect()


def test_scans_are_not_remembered(spark, scratch):
    from urbanlens.sources import testdata

    spark.range(3).write.parquet(f"{scratch}/region.parquet")
    assert testdata.table(spark, scratch, "region").count() == 3
    spark.range(5).write.mode("append").parquet(f"{scratch}/region.parquet")
    assert testdata.table(spark, scratch, "region").count() == 8
