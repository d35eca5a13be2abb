import random

import numpy as np
import pyarrow as pa

from tests.llm import brute
from tests.llm.conftest import SMALL, frame
from urbanlens.llm import jaccard
from urbanlens.llm.common import text_blocks


def shingles(text, k=3):
    w = brute.lower(text).encode().split()
    return {b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def plain(texts, percent=90):
    """Root (a row number) of each row's component, None for empty sets."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    root[find(i)] = find(j)
    return [find(i) if sets[i] else None for i in range(len(texts))], [len(s) for s in sets]


def expected(rows):
    roots, sizes = plain([t for _, t in rows])
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        if r is not None and i is not None:
            least[r] = min(i, least.get(r, i))
    return sorted(((i, n, i if r is None else least.get(r)) for (i, _), r, n in zip(rows, roots, sizes, strict=True)), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def edited(rnd, words, n):
    words = list(words)
    for _ in range(n):
        at = rnd.randrange(len(words))
        words[at : at + rnd.randrange(2)] = [f"e{rnd.randrange(10**6)}"] * rnd.randrange(2)
    return words


def test_query_equals_brute_force(spark, small_docs):
    got = result(jaccard.query(spark, SMALL))
    assert got == expected([(i, t) for i, t, _ in small_docs])
    assert len({c for _, _, c in got}) < len(got)


def test_planted_families_of_all_sizes(spark):
    rnd = random.Random(1)
    rows = []
    for size in (9, 10, 11, 12, 20, 21, 45, 150, 700, 3000):
        base = [f"w{rnd.randrange(5000)}" for _ in range(size)]
        rows += [" ".join(edited(rnd, base, rnd.randrange(max(2, size // 50 + 1)))) for _ in range(12)]
    rnd.shuffle(rows)
    rows = list(enumerate(rows))
    assert result(jaccard.components(frame(spark, rows))) == expected(rows)


def test_hot_family_in_many_blocks(spark):
    rnd = random.Random(4)
    base = [f"w{rnd.randrange(5000)}" for _ in range(120)]
    rows = [" ".join(edited(rnd, base, 2)) for _ in range(150)] + [" ".join(edited(rnd, base, 6)) for _ in range(150)]
    rows = list(enumerate(rows))
    want = expected(rows)
    assert 1 < len({c for _, _, c in want}) < 300
    assert result(jaccard.components(frame(spark, rows), block_sets=16)) == want


def test_edge_rows(spark):
    text = " ".join(f"v{i}" for i in range(40))
    rows = [(7, text), (3, text.upper()), (3, text + " more"), (None, text), (9, None), (8, ""), (6, " \n\t"), (11, "a"), (10, "A"), (12, "a b"), (13, "lone words here " * 50_000), (14, "lone words here lone words"), (None, None)]
    assert result(jaccard.components(frame(spark, rows))) == expected(rows)
    assert jaccard.components(frame(spark, rows).where("false")).count() == 0


def test_sets_are_those_of_plain_splitting():
    rnd = random.Random(9)
    texts = ["", "A", "b c", "é x y Z\x1cq", " lead and  tail\n"] + ["".join(rnd.choice("aB é\n\t\x0b.") for _ in range(rnd.randrange(60))) for _ in range(200)]
    for _, _, data, offsets in text_blocks(pa.array(texts)):
        values, ends = jaccard.shingle_sets(data, offsets)
        assert np.diff(ends).tolist() == [len(shingles(t)) for t in texts]
        named = {}
        for t, v in zip(texts, jaccard.set_ids(values, ends).tolist(), strict=True):
            assert named.setdefault(frozenset(shingles(t)), v) == v
        assert len(set(named.values())) == len(named)


def test_linked_sets_share_a_key():
    rnd = np.random.default_rng(3)
    for size in (10, 11, 12, 15, 19, 20, 38, 57, 100, 333, 1000):
        for _ in range(40):
            base = rnd.integers(0, 2**63, size, np.uint64)
            most = size // 10
            a = np.unique(base)
            b = np.unique(np.concatenate([base[rnd.integers(0, most + 1) :], rnd.integers(0, 2**63, rnd.integers(0, most + 1), np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both < 90 * (len(a) + len(b) - both) or (len(a) == len(b) and (a == b).all()):
                continue
            key, row = jaccard.part_keys(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            assert set(key[row == 0].tolist()) & set(key[row == 1].tolist())


def test_trees_find_what_connects():
    rnd = random.Random(6)
    sets = []
    for _ in range(8):
        base = rnd.sample(range(10**6), rnd.choice([12, 60, 200]))
        for _ in range(30):
            keep = [x for x in base if rnd.random() > 0.03] + [rnd.randrange(10**6) for _ in range(rnd.randrange(3))]
            sets.append(np.unique(np.array(keep, np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    rnd.shuffle(sets)
    ids = np.arange(len(sets))

    def roots(pairs):
        label = list(range(len(sets)))
        for i, j in pairs:
            x, y = label[i], label[j]
            label = [x if v == y else v for v in label]
        return [label.index(v) for v in label]

    want = [(i, j) for i in ids.tolist() for j in range(i) if 10 * len(b := np.intersect1d(sets[i], sets[j])) >= 9 * (len(sets[i]) + len(sets[j]) - len(b))]
    for bits in (256, 4096):
        tree = jaccard.Tree(ids, sets, bits)
        src, dst = jaccard.join_trees(tree, tree, np.arange(len(sets)))
        assert roots(zip(src, dst, strict=True)) == roots(want) and len(src) < len(sets)
        half = len(sets) // 2
        a, b = jaccard.Tree(ids[:half], sets[:half], bits), jaccard.Tree(ids[half:], sets[half:], bits)
        src, dst = jaccard.join_trees(a, b, np.arange(len(sets)))
        assert roots(zip(src, dst, strict=True)) == roots([p for p in want if (p[0] < half) != (p[1] < half)])
