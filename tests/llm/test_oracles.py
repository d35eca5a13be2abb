import duckdb
import pytest

from tests.llm.conftest import SMALL
from urbanlens.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels", "conversations", "embeddings"):
        con.sql(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    want = con.sql(ORACLE_SQL[name]).df()
    got = QUERIES[name](spark, SMALL).toPandas()[list(want.columns)]
    key = list(want.columns)
    assert sorted(map(tuple, got[key].values.tolist()), key=str) == sorted(map(tuple, want[key].values.tolist()), key=str)
