import hashlib

from tests.llm import brute
from tests.llm.conftest import SMALL, frame, written
from urbanlens.llm import fingerprint


def expected(docs):
    """By (doc_id, text) in descending id, equal ids by text."""
    rows = sorted(((i, t or "") for i, t in docs), key=lambda r: (-r[0] if r[0] is not None else float("inf"), r[1]))
    out = []
    for n, (i, text) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, edit, following = (brute.entries(t) for t in (text, edited, after))
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), brute.digest(own), brute.digest(edit), brute.jaccard(own, edit), brute.jaccard(own, following)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark, small_docs):
    assert rows_of(fingerprint.query(spark, SMALL)) == expected([(i, t) for i, t, _ in small_docs])


def test_edges(spark, scratch):
    cases = [(5, "a b c d e f g h i j k l m n o p"), (5, "a b c d e f g h i j k l m n o p"), (9, None), (2, ""), (7, "é\U0001f600 zwei"), (1, "  "), (4, "word " * 3000), (None, "no id here at all")]
    folder = written(spark, scratch, documents=frame(spark, cases))
    assert rows_of(fingerprint.query(spark, folder)) == expected(cases)
    one = written(spark, scratch + "/one", documents=frame(spark, [(1, "only one document stands here")]))
    assert rows_of(fingerprint.query(spark, one)) == expected([(1, "only one document stands here")])
    none = written(spark, scratch + "/none", documents=frame(spark, []))
    assert fingerprint.query(spark, none).count() == 0


def test_shared_run_shares_an_entry(spark):
    run = " ".join(f"w{i}" for i in range(fingerprint.GRAM + fingerprint.WINDOW - 1))
    df = spark.createDataFrame([("x1 x2 " + run, "y1 y2 y3 " + run + " z")], "a string, b string")
    df = fingerprint.with_fingerprint(fingerprint.with_fingerprint(df, "a", "fa"), "b", "fb")
    row = df.select(fingerprint.hashes("fa").alias("x"), fingerprint.hashes("fb").alias("y"), fingerprint.positions("fa").alias("p")).first()
    assert set(row.x) & set(row.y) and row.p == sorted(row.p)


def test_plan_has_no_python(spark):
    plan = fingerprint.query(spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
