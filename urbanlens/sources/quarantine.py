"""Text rows that do not fit their schema (A2): kept apart, counted, never guessed.

A CSV row with too few or too many fields, or with a field that is no value of its column, is
bad. Good and bad rows are written in one pass, to folders of one table: ``bad=false`` has the typed
columns, ``bad=true`` the row as it was read, its file and what was wrong. The counts
come from the same pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Loaded:
    good: DataFrame
    bad: DataFrame
    rows_good: int
    rows_bad: int


def with_faults(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header: bool = True, encoding: str = "UTF-8", null_values: str | None = None) -> DataFrame:
    """Typed columns, ``_corrupt_record`` (the text of a bad row), ``fault`` (NULL, ``short``, ``long`` or ``value``) and ``file``."""
    if CORRUPT in schema.fieldNames():
        raise ValueError(f"the schema has a column {CORRUPT} of its own")
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(wide).option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    # the whole row is parsed even if few columns are asked for: else short rows pass
    reader = reader.option("sep", sep).option("encoding", encoding).option("columnPruning", False).option("enforceSchema", True)
    if null_values is not None:
        reader = reader.option("nullValue", null_values)
    rows = reader.csv(path)
    n = len(schema.fields)
    # fields of a row with quoted separators taken as one
    fields = F.size(F.split(F.regexp_replace(F.col(CORRUPT), r'"(?:[^"\\]|\\.|"")*"', ""), f"\\Q{sep}\\E"))
    fault = F.when(F.col(CORRUPT).isNull(), None).when(fields < n, "short").when(fields > n, "long").otherwise("value")
    return rows.withColumns({"fault": fault, "file": F.col("_metadata.file_path")})


def load(
    spark: SparkSession, path: str, schema: T.StructType, dst: str, most_bad: float | None = None, **options
) -> Loaded:
    """Write the good and the bad rows of ``path`` below ``dst``. More than a share ``most_bad`` of bad rows is an
    error, raised after both are written."""
    counts = Observation()
    rows = with_faults(spark, path, schema, **options).withColumn("bad", F.col("fault").isNotNull())
    counted = rows.observe(counts, F.count_if(~F.col("bad")).alias("good"), F.count_if("bad").alias("bad"))
    counted.write.mode("overwrite").partitionBy("bad").parquet(dst)
    good, bad = counts.get["good"], counts.get["bad"]
    found = spark.read.schema(rows.schema).parquet(dst)
    loaded = Loaded(
        found.where("not bad").select(*schema.fieldNames()),
        found.where("bad").select(F.col(CORRUPT).alias("record"), "fault", "file"), good, bad,
    )
    if most_bad is not None and good + bad and bad / (good + bad) > most_bad:
        raise ValueError(f"{bad} of {good + bad} rows of {path} are bad; they are in {dst}/bad=true")
    return loaded
