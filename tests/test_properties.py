"""Property-based checks of core operators against plain-Python references."""

import datetime as dt
import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from urbanlens.functions import round_half_even
from urbanlens.operators import cleaning, recsys, sampling

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

edge_floats = st.one_of(
    st.none(),
    st.sampled_from([-5.0, 0.0, 1e-9, 100.0, 100.01, 800.0, 800.01]),
    st.floats(min_value=-10, max_value=1000, allow_nan=False),
)


def py_valid(fare, dist, pax):
    return (fare is not None and 0 < fare <= 800 and dist is not None and 0 < dist <= 100
            and pax is not None and pax > 0)


@SETTINGS
@given(st.lists(st.tuples(edge_floats, edge_floats, edge_floats), min_size=1, max_size=40))
def test_filter_valid_matches_python(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "i int, fare_amount double, trip_distance double, passenger_count double")
    got = sorted(r.i for r in cleaning.filter_valid(df).collect())
    assert got == [i for i, r in enumerate(rows) if py_valid(*r)]


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=100), min_size=1, max_size=40),
       st.lists(st.integers(min_value=1, max_value=30), min_size=1, max_size=4))
def test_segments_match_python(spark, stamps, steps):
    day = lambda n: dt.date(1970, 1, 1) + dt.timedelta(days=n)
    first, ends, acc = 1, [], 1
    for s in steps:
        acc += s
        ends.append(acc)
    ends[-1] = None  # open last slice
    slices = recsys.Slices(day(first), tuple(None if e is None else day(e) for e in ends))
    df = spark.createDataFrame([(i, t * 21_600) for i, t in enumerate(stamps)], "i int, ts long")
    got = {r.i: r.segment for r in recsys.assign_segment(df, slices).collect()}

    def seg(t):
        if t < 4 * first:  # stamps count quarter days
            return None
        return next(k for k, e in enumerate(ends) if e is None or t < 4 * (e + 1))

    assert got == {i: seg(t) for i, t in enumerate(stamps) if seg(t) is not None}


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 500), st.integers(1, 80)), min_size=1, max_size=30))
def test_round_half_even_matches_python(spark, pairs):
    df = spark.createDataFrame([(s / c,) for s, c in pairs], "x double")
    got = [r.r for r in df.select(round_half_even("x", 2).alias("r")).collect()]
    assert got == [round(s / c, 2) for s, c in pairs]


@SETTINGS
@given(st.dictionaries(st.integers(0, 3), st.integers(1, 400), min_size=1, max_size=4),
       st.floats(min_value=0.01, max_value=0.99))
def test_sample_keys_matches_brute_force(spark, sizes, fraction):
    data = [(g, g * 10_000 + k) for g, n in sizes.items() for k in range(n)]
    df = spark.createDataFrame(data, "g int, k long")
    out = sampling.sample_keys(df, "k", fraction, seed=7, groups=["g"], seed_offset="g")
    got = {}
    for r in out.collect():
        got.setdefault(r.g, set()).add(r.k)
    for g, n in sizes.items():
        keys = [k for gg, k in data if gg == g]
        md5 = lambda k: hashlib.md5(f"{7 + g}:{k}".encode()).hexdigest()
        want = set(sorted(keys, key=lambda k: (md5(k), k))[: max(1, int(n * fraction))])
        assert got.get(g, set()) == want
