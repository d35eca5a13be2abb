import random

from tests.llm import brute
from tests.llm.conftest import frame, written
from urbanlens.llm import decontam


def check(spark, docs, items):
    frames = frame(spark, list(enumerate(docs))), spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in decontam.contamination(*frames, ["doc_id"]).collect()}
    want = brute.contamination(docs, items)
    assert got == dict(enumerate(want))


def test_equals_brute_force_on_random_words(spark):
    rnd = random.Random(11)
    word = lambda: rnd.choice(["a", "b", "c", "É", "9"])
    docs = [" ".join(word() for _ in range(rnd.randrange(0, 60))) for _ in range(150)]
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 2, 4, 5, 5, 9, 10, 11, 14, 30])]
    docs += [f"x y {t} z" for _, t in items] + [t for _, t in items]
    check(spark, docs, items[3:])
    check(spark, docs[:60], items)


def test_edges(spark):
    ten = "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10"
    docs = [None, "", "!!!", ten.upper(), ten.replace(" ", "-.-"), ten + " x " + ten, "w2 " + ten[3:], ten * 1, "pre " + "long text " * 100_000 + ten]
    items = [(1, ten), (1, ten), (2, ten + " more"), (None, ten), (3, ""), (4, None), (5, "?!")]
    check(spark, docs, items)
    check(spark, docs, [(1, None)])
    check(spark, docs, [])
    check(spark, [], items)
    same = frame(spark, [(1, ten), (1, ten), (None, ten)])
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontam.contamination(same, bench, ["doc_id"]).where("n_hit = 10").count() == 3


def test_stage_drops_only_contaminated(spark, scratch):
    ten = "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10"
    folder = written(spark, scratch, benchmark=spark.createDataFrame([(1, ten)], "item_id long, text string"))
    docs = frame(spark, [(1, "x " + ten), (2, ten[:-3]), (None, ten), (None, "clean"), (3, None)])
    kept = decontam.drop_contaminated(spark, docs, folder)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, "clean"), (2, ten[:-3]), (3, "")]
