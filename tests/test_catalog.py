"""Every registered query against its DuckDB oracle on the smallest data set."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from urbanlens.plans import catalog

from .conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings"]
MODEL_QUERIES = {"fare_model_metrics", "fare_model_importance", "scored_by_hour_bin", "scored_by_zone"}


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v:.9g}"
    return str(v)


def _digest(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in data)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 1 and "avg_fare" in df.columns


def test_every_query_has_oracle_or_is_listed(spark):
    rows_only = set(catalog.QUERIES) - set(catalog.ORACLE_SQL)
    assert rows_only == MODEL_QUERIES | {"latent_item_vectors"}  # checked against NumPy


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(catalog.ORACLE_SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)


def test_approx_profile_close_to_exact(spark):
    exact = {tuple(r[:5]): r[5] for r in entry.queries()["sensor_median_profile"](spark, SF_SMALL).collect()}
    approx = {tuple(r[:5]): r[5] for r in entry.queries()["sensor_median_profile_approx"](spark, SF_SMALL).collect()}
    assert exact == approx  # groups are far below the sketch's exactness limit
