"""Readers (A1–A6, A9–A12). Text sources always get a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared schemas of the raw text inputs (types we choose; see FIXTURES.md).
SENSOR_COUNTS_SCHEMA = T.StructType(
    [
        T.StructField("SegmentID", T.IntegerType()),
        T.StructField("Boro", T.StringType()),
        T.StructField("street", T.StringType()),
        T.StructField("Yr", T.IntegerType()),
        T.StructField("M", T.IntegerType()),
        T.StructField("D", T.IntegerType()),
        T.StructField("HH", T.IntegerType()),
        T.StructField("MM", T.IntegerType()),
        T.StructField("Vol", T.StringType()),
    ]
)
MOVIES_SCHEMA = T.StructType(
    [
        T.StructField("MovieID", T.IntegerType()),
        T.StructField("Title", T.StringType()),
        T.StructField("Genres", T.StringType()),
    ]
)
RATINGS_SCHEMA = T.StructType(
    [
        T.StructField("UserID", T.IntegerType()),
        T.StructField("MovieID", T.IntegerType()),
        T.StructField("Rating", T.IntegerType()),
        T.StructField("Timestamp", T.LongType()),
    ]
)
ZONE_LOOKUP_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Scan a Parquet file or directory; ``columns`` prunes the scan up front."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = True,
    null_values: str | None = None,
) -> DataFrame:
    """CSV with a declared schema (no inference pass over the data)."""
    reader = spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
    if null_values is not None:
        reader = reader.option("nullValue", null_values)
    return reader.csv(path)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = "::",
    encoding: str = "ISO-8859-1",
) -> DataFrame:
    """Header-less text with a multi-character separator and a legacy encoding."""
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("header", False)
        .csv(path)
    )


def load_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Ratings in the ``::`` text format, renamed to the engine's column names."""
    return read_delimited(spark, path, RATINGS_SCHEMA).select(
        F.col("UserID").alias("user_id"),
        F.col("MovieID").alias("item_id"),
        F.col("Rating").alias("rating"),
        F.col("Timestamp").alias("ts"),
    )


def load_movies(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, MOVIES_SCHEMA).select(
        F.col("MovieID").alias("item_id"),
        F.col("Title").alias("title"),
        F.col("Genres").alias("genres"),
    )


def read_lookup(
    spark: SparkSession,
    path: str,
    key: str = "LocationID",
    value: str = "Borough",
    value_alias: str = "Boro_Name",
    schema: T.StructType = ZONE_LOOKUP_SCHEMA,
    missing: tuple[str, ...] = ("N/A", "Unknown", ""),
) -> DataFrame:
    """Small lookup CSV -> ``(key, value_alias)``; placeholder names become NULL."""
    df = read_csv(spark, path, schema)
    v = F.trim(F.col(value))
    return df.select(
        F.col(key),
        F.when(v.isin(*missing), F.lit(None)).otherwise(v).alias(value_alias),
    )


def read_report_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read back a report written by ``write_report_csv``."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Item vector table ``(item_id, embedding array<float>)``."""
    return spark.read.parquet(path)


def read_state(spark: SparkSession, path: str, iteration: int | None = None) -> DataFrame:
    """Per-iteration state; a given iteration prunes to one Parquet partition."""
    df = spark.read.parquet(path)
    return df if iteration is None else df.filter(F.col("iteration") == iteration)
