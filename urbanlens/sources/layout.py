"""Tables laid out for their joins (A7, P3, P5): bucketed and sorted on a key.

Trips and whatever is joined to them by ``trip_id`` (features, splits, scores, labels) are stored
in the same number of buckets by that key, sorted inside. Joins, aggregates and
windows on the key then read buckets side by side: no exchange and, for joins, no sort of the facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET_BYTES = 512 << 20


def buckets_for(rows_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets so that one holds about ``bucket_bytes``: a power of two, so that tables of different size
    still divide each other's buckets."""
    n = 1
    while n * bucket_bytes < rows_bytes:
        n *= 2
    return n


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int, extra_sort: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to ``path`` as ``table`` with one file per bucket and return it as read from there. NULL keys are a bucket's
    rows like any other."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    (
        df.repartition(buckets, key).sortWithinPartitions(key, *extra_sort)
        .write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key, *extra_sort).option("path", path).saveAsTable(table)
    )
    return spark.table(table)


def attach(spark: SparkSession, table: str, path: str, schema: str, key: str, buckets: int) -> DataFrame:
    """Declare a table that ``write_bucketed`` left in ``path`` in a new session."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def join_on_key(facts: DataFrame, other: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join two tables bucketed alike on their key, without exchange on either side."""
    return facts.join(other.hint("merge"), key, how)


def exchanges(df: DataFrame) -> int:
    """Shuffles in the plan of ``df`` (not those of broadcasts)."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum(1 for line in plan.splitlines() if "Exchange" in line and "BroadcastExchange" not in line and "ReusedExchange" not in line)


def bucket_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per value of the key, from the buckets alone."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
