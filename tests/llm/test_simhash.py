import random

import numpy as np

from tests.llm import brute
from tests.llm.conftest import SMALL, frame
from urbanlens.llm import simhash


def test_planes_cover_every_pair_within_three_bits():
    assert len(simhash.PLANES) == 14
    for a in range(8):
        for b in range(a, 8):
            for c in range(b, 8):
                assert any(not {a, b, c} & set(p) for p in simhash.PLANES)


def test_query_equals_brute_force(spark, small_docs):
    got = {r.doc_id: r for r in simhash.query(spark, SMALL).collect()}
    prints = {i: brute.simhash(t) for i, t, _ in small_docs}
    root = brute.components(prints.values())
    least = {}
    for i, v in prints.items():
        least[root[v]] = min(i, least.get(root[v], i))
    assert {i: (f"{v:016x}", least[root[v]]) for i, v in prints.items()} == {i: (r.fingerprint, r.component_id) for i, r in got.items()}


def test_links_connect_exactly_even_with_long_lists(spark):
    rnd = random.Random(3)
    values = {0, 1, 2**63, 2**64 - 1}
    for _ in range(6):
        center = rnd.getrandbits(64)
        values |= {center ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(60)}
    values |= {rnd.getrandbits(64) for _ in range(300)}
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    want = brute.components(values)
    for longest in (4096, 5):
        edges = simhash.links(fps, 3, longest)
        assert edges.count() <= 14 * 4 * len(values)
        found = {r.node % 2**64: r.root % 2**64 for r in simhash.connected_components(edges).collect()}
        groups = {}
        for v in values:
            groups.setdefault(want[v], set()).add(found.get(v, v))
        assert all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_forest_is_linear():
    x = np.array([0b111 & i for i in range(8)] * 1, np.uint64)
    src, dst = simhash._forest(np.unique(x), 3)
    assert len(src) == len(dst) == 7


def test_edge_rows_and_stage(spark):
    text = "one two three four five six seven eight nine ten"
    docs = frame(spark, [(7, text), (3, text), (3, text), (3, "another text that is not like the rest at all"), (None, text), (9, None), (8, ""), (10, "a"), (11, "lone words here " * 100_000)])
    got = simhash.components(docs).collect()
    assert {r.component_id for r in got if r.fp == brute.simhash(text) or r.fp == brute.simhash(text) - 2**64} == {3}
    assert {(r.doc_id, r.component_id) for r in got if r.fp == 0} == {(8, 8), (9, 8)}
    kept = simhash.keep_one_of_each(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 8, 10, 11]
    assert simhash.keep_one_of_each(spark, docs.where("false"), "").count() == 0
    only = frame(spark, [(None, text), (None, text)])
    assert simhash.keep_one_of_each(spark, only, "").count() == 1
