import duckdb

from tests.llm.conftest import frame
from urbanlens.llm import toxicity


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    toxic = dict(duckdb.sql(f"select doc_id, max(toxic) from '{folder}/labels.parquet' group by 1").fetchall())
    rows = toxicity.query(spark, folder).collect()
    held = [(toxic[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in toxic]
    caught = [p for t, p in held if t]
    assert len(rows) == 10_000 and sum(caught) > 0.85 * len(caught)
    assert sum(p for t, p in held if not t) < 0.03 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_features_equal_brute_force():
    import numpy as np
    import pyarrow as pa

    from urbanlens.llm.common import text_blocks

    _, _, data, offsets = next(text_blocks(pa.array(["Ab abc, ab", "", "abc"])))
    v = toxicity.Vocabulary(data, offsets)
    weights = np.ones(1 << toxicity.BITS)
    grams = lambda w: sum(max(0, len(w) + 2 - n + 1) for n in toxicity.SIZES)
    sums = v.word_sums(weights)
    assert sorted(sums.tolist()) == sorted([grams("ab"), grams("abc")])
    assert np.bincount(v.row, minlength=3).tolist() == [2, 0, 1]


def test_edges(spark):
    good, bad = "a kind and calm remark about the weather ", "you awful zzgrub person "
    docs = frame(spark, [(i, (bad if i % 4 == 0 else good) * 3 + f"x{i}") for i in range(80)] + [(100, None), (101, ""), (102, "zzgrub"), (102, "zzgrub"), (None, good), (103, good * 20_000)])
    marks = labels(spark, [(i, 1, int(i % 4 == 0)) for i in range(80)] + [(0, 1, 0), (None, 0, 1), (999, 0, 1), (5, None, None)])
    model = toxicity.fit(toxicity.training_rows(docs, marks))
    out = toxicity.score(docs, model).collect()
    score = {r.doc_id: r.score for r in out}
    assert len(out) == docs.count() and score[102] > 0.3 and score[100] == score[101]
    assert score[None] < 0.3 and score[103] < 0.3
    one = toxicity.fit(toxicity.training_rows(docs, marks.where("toxic = 0 and doc_id > 0")))
    assert all(r.score < 0.01 for r in toxicity.score(docs, one).collect())
    none = toxicity.fit(toxicity.training_rows(docs, marks.where("false")))
    assert all(r.score < 0.01 for r in toxicity.score(docs, none).collect())
    assert toxicity.score(docs.where("false"), model).count() == 0


def grams(word):
    text = f" {word} "
    return {text[i : i + n] for n in toxicity.SIZES for i in range(len(text) - n + 1)}


def number(gram_word):
    """The feature numbers of a word, by the operator's own hash, per n-gram."""
    import pyarrow as pa

    from urbanlens.llm.common import text_blocks

    _, _, data, offsets = next(text_blocks(pa.array([gram_word])))
    return toxicity.Vocabulary(data, offsets)


def test_ratios_selection_and_scores_equal_brute_force(spark):
    import math
    import random

    import numpy as np

    rnd = random.Random(12)
    mild, foul = [f"{a}{b}en" for a in "bdfg" for b in "aeio"], [f"z{a}x{b}" for a in "aeu" for b in "gkr"]
    texts = [(int(i % 3 == 0), " ".join(rnd.choice(mild + (foul if i % 3 == 0 else mild[:2])) for _ in range(rnd.randrange(1, 12)))) for i in range(240)]
    # plain counts of the documents of each class that have an n-gram
    has = [(t, set().union(*(grams(w) for w in set(text.split())))) for t, text in texts]
    n = [sum(t == c for t, _ in has) for c in (0, 1)]
    count = {g: [sum(g in s for t, s in has if t == c) for c in (0, 1)] for g in set().union(*(s for _, s in has))}
    total = [sum(v[c] + 1 for v in count.values()) for c in (0, 1)]
    want = {}
    for g, (q, p) in count.items():
        mean = (p + q) / sum(n)
        z = (p / n[1] - q / n[0]) / math.sqrt(max(mean * (1 - mean), 1e-12) * (1 / n[0] + 1 / n[1]))
        if abs(z) >= toxicity.LEAST_Z:
            want[g] = math.log((p + 1) / total[1]) - math.log((q + 1) / total[0])
    order = sorted(count)
    r, telling = toxicity.ratios(np.array([count[g][0] for g in order]), np.array([count[g][1] for g in order]), *map(float, n))
    assert {g for g, x in zip(order, telling, strict=True) if x} == set(want)
    assert all(abs(x - want[g]) < 1e-12 for g, x, use in zip(order, r, telling, strict=True) if use)
    # the fitted model weighs exactly the chosen n-grams
    rows = spark.createDataFrame(texts, "toxic int, text string")
    model = toxicity.fit(rows)
    numbers = {}
    for w in {w for _, text in texts for w in text.split()}:
        v, text = number(w), f" {w} "
        found, at = sorted(v.feature.tolist()), []
        for size in toxicity.SIZES:
            at += [text[i : i + size] for i in range(len(text) - size + 1)]
        assert len(found) == len(at)
        for size in toxicity.SIZES:  # features come size by size, in order of place
            mine = [text[i : i + size] for i in range(len(text) - size + 1)]
            numbers |= dict(zip(mine, v.feature[: len(mine)].tolist(), strict=True))
            v.feature = v.feature[len(mine) :]
    assert len(set(numbers.values())) == len(numbers) == len(count)
    weighed = {g for g in count if model.weights[numbers[g]] != 0}
    assert weighed <= set(want) and len(weighed) > 0.5 * len(want)
    # scores: the logistic of the intercept and the weights of all n-grams of each distinct word
    got = toxicity.score(rows, model).collect()
    for row in got:
        line = model.intercept
        for w in set(row.text.split()):
            text = f" {w} "
            line += sum(model.weights[numbers[text[i : i + k]]] for k in toxicity.SIZES for i in range(len(text) - k + 1))
        assert abs(row.score - 1 / (1 + math.exp(-line))) < 1e-9
    assert np.mean([(r.score >= 0.3) == bool(r.toxic) for r in got]) > 0.9


def test_no_feature_that_tells_is_dropped():
    import numpy as np

    # 30,000 features, all of them telling
    clean, toxic = np.zeros(30_000, np.int64), np.full(30_000, 400)
    assert toxicity.ratios(clean, toxic, 1000.0, 1000.0)[1].all()
