"""File-stream trip cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from urbanlens.plans.jobs import clean_trips


def clean_trips_stream(
    spark: SparkSession, source_dir: str, schema: T.StructType, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Streaming DataFrame of cleaned trips from Parquet files in ``source_dir``.

    A file stream needs a declared schema (no inference on an open-ended source).
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return clean_trips(reader.parquet(source_dir))


def start_clean_trips(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    sink_dir: str,
    checkpoint_location: str,
    available_now: bool = True,
    partition_by: list[str] | None = None,
) -> StreamingQuery:
    """Start the incremental job; ``available_now`` processes what is there and stops."""
    writer = (
        clean_trips_stream(spark, source_dir, schema)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint_location)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(sink_dir)
