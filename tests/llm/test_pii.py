import hashlib
import random

from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import SMALL, frame
from urbanlens.llm import pii


def found(spark, texts):
    rows = pii.detect(frame(spark, list(enumerate(texts)))).collect()
    return {r.doc_id: [(s.kind, s.start, s.end) for s in r.pii] for r in rows}


def test_base_kinds_equal_plain_regular_expressions(spark):
    rnd = random.Random(5)
    letters = "0123456789..@ab-+ () 4é\U0001f600_%"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 80))) for _ in range(1500)]
    texts += [None, "", "a@b.c_d@e.f", "a@b.c@d.e", "1.2.3.4.5.6.7.8.9", "4111 1111 1111 1111 1", "4111-1111-1111-1111", "+1 (974) 555-3436 4111111111111111", "000.1.02.0255"]
    # long runs, on which a rescan from every position would not end
    texts += ["a@" + "b." * 50_000 + "c", "1." * 50_000, "+1" + "(" * 50_000, "4111 1111 1111 1111, " * 1_000, "1-" * 50_000, "@" * 50_000]
    got = found(spark, texts)
    for i, t in enumerate(texts):
        assert [s for s in got[i] if s[0] in pii.BASE] == brute.base_spans(t), t[:80]


def test_very_long_runs_end(spark):
    got = found(spark, ["1" * 300_000, "a" * 300_000, "A1" * 100_000, "AB12" + " ABCD" * 50_000])
    assert not any(got.values())


def test_query(spark, small_docs):
    got = {r.doc_id: r for r in pii.query(spark, SMALL).collect()}
    for i, t, _ in small_docs:
        spans = brute.base_spans(t)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert got[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in spans) for k in pii.BASE]


def test_checksums_and_context(spark):
    token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    texts = [
        "GB82 WEST 1234 5698 7654 32", "GB82 WEST 1234 5698 7654 33", f'token = "{token}"', f'thing = "{token}"',
        "ssn 123-45-6789", "123-45-6789", "ssn 000-45-6789", "card 4111 1111 1111 1112",
    ]
    kinds = {i: [s[0] for s in x] for i, x in found(spark, texts).items()}
    assert kinds == {0: ["iban"], 1: [], 2: ["secret"], 3: [], 4: ["national_id"], 5: [], 6: [], 7: []}


def test_redaction_and_stage(spark):
    docs = frame(spark, [(1, "mail a.b@c.de or +1 (974) 555-3436!"), (2, None), (3, ""), (None, "ip 1.2.3.4 \U0001f600 4111111111111111"), (None, "clean")])
    out = pii.mask_personal_data(spark, docs, "")
    assert out.columns == docs.columns
    texts = [r.text for r in out.orderBy(F.col("doc_id").asc_nulls_last(), F.desc("text")).collect()]
    assert texts == ["mail <EMAIL> or <PHONE>!", None, "", "ip <IP> \U0001f600 <CARD>", "clean"]
    assert pii.mask_personal_data(spark, docs.where("false"), "").count() == 0
    assert out.where("text is not null and n_chars <> length(text)").count() == 0


def test_plan_has_no_python(spark):
    plan = pii.query(spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
