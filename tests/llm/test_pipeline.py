import re

import numpy as np

import __spark_entry__
import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import SMALL, frame, written
from urbanlens.llm import pii

ITEM = "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"


def fixture(small_docs):
    docs = [(i, t) for i, t, _ in small_docs[:120]]
    text = max((t for _, t in docs), key=len)
    docs += [
        (1000, text), (1001, text), (1002, "1234 !!"), (1003, None), (1004, ""), (1005, f"the text has {ITEM.upper()} inside of it"),
        (1006, "the mail a.b@c.de and card 4111 1111 1111 1111 are in this"), (1006, "the mail a.b@c.de and card 4111 1111 1111 1111 are in this"),
    ]
    return docs


def by_hand(docs):
    """{doc_id: ids} of plain single-process stages."""
    docs = [(i, t) for i, t in docs if t and re.search(r"[^\W\d_]", t)]
    prints = {i: brute.simhash(t) for i, t in docs}
    root = brute.components(prints.values())
    first = {}
    for i in sorted(prints):
        first.setdefault(root[prints[i]], i)
    docs = {i: t for i, t in docs if first[root[prints[i]]] == i}
    hits = brute.contamination(docs.values(), [(1, ITEM)])
    docs = {i: t for (i, t), h in zip(docs.items(), hits, strict=True) if not h[1]}
    coder, out = brute.encoding(), {}
    for i, t in docs.items():
        for kind in pii.KINDS:
            if kind.name in brute.BASE:
                t = re.sub(brute.BASE[kind.name], lambda m, k=kind: k.mask if brute.valid(k.name, m.group()) else m.group(), t)
        t = re.sub(r'token = "[0-9a-f]{40}"', 'token = "<SECRET>"', t)
        out[i] = coder.encode_ordinary(t)
    return out


def test_run_equals_plain_stages(spark, small_docs, scratch):
    docs = fixture(small_docs)
    folder = written(
        spark, scratch, documents=frame(spark, docs, extra=False),
        benchmark=spark.createDataFrame([(1, ITEM)], "item_id long, text string"),
    )
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in corpus_pipeline.run(spark, folder).collect()}
    assert got == by_hand(docs)


def test_stages_keep_the_columns_and_read_their_input(spark, scratch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and "pipeline" in __spark_entry__.queries()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(20), SMALL)
        assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]


def test_oracles_name_registered_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {q[: q.index("_") + 1] for q in __spark_entry__.queries() if re.match(r"op\d+_", q)}
