"""Incremental user state (A12, I4, I5, P9): iteration i reads only its new ratings.

Ratings are stored by segment (the first slice that contains them), one folder each. The
state of iteration i holds, for every user, mergeable sums: the number of liked
items with a vector and the sum of those vectors. It is the state of iteration i - 1 plus the
sums over segment i; taste vectors are the sums' directions. What was read for an earlier iteration
is never read again, an iteration can be rebuilt alone, and the result equals a full rebuild.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.functions.vectors import l2_normalize
from urbanlens.operators.recsys import MIN_LIKED_RATING, Slices, assign_segment
from urbanlens.sources import sinks


def write_segments(ratings: DataFrame, slices: Slices, path: str) -> None:
    """Ratings of all slices, a folder per segment; only segments present in ``ratings`` are replaced."""
    rows = assign_segment(ratings, slices).select("user_id", "item_id", "rating", "ts", "segment")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("segment").parquet(path)


def segment_ratings(spark: SparkSession, path: str, segment: int) -> DataFrame:
    """Ratings that are new in a slice: one folder is scanned."""
    return spark.read.parquet(path).where(F.col("segment") == segment)


def partial_sums(ratings: DataFrame, vectors: DataFrame, min_rating: int = MIN_LIKED_RATING) -> DataFrame:
    """``(user_id, n_vectors, total)`` over liked ratings. Likes are counted per (user, item) first, so a popular
    item meets its vector once a user; vectors of different widths are an error."""
    liked = ratings.where(F.col("rating") >= min_rating).groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("n"))
    vec = vectors.where("embedding is not null").select("item_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("__v"))
    summed = liked.join(vec, "item_id").groupBy("user_id").agg(F.sum("n").alias("n_vectors"), Summarizer.sum(F.col("__v"), F.col("n").cast("double")).alias("__v"))
    return summed.select("user_id", "n_vectors", vector_to_array("__v").alias("total"))


def merge_sums(before: DataFrame, new: DataFrame) -> DataFrame:
    """Sums of both: one row per user of either."""
    joined = before.select("user_id", F.col("n_vectors").alias("n0"), F.col("total").alias("t0")).join(new, "user_id", "full")
    both = F.zip_with("t0", "total", lambda a, b: a + b)
    added = F.when(F.col("t0").isNull(), F.col("total")).when(F.col("total").isNull(), F.col("t0")).when(
        F.size("t0") == F.size("total"), both).otherwise(F.raise_error(F.lit("vectors of different widths")).cast("array<double>"))
    n = F.coalesce("n0", F.lit(0)) + F.coalesce("n_vectors", F.lit(0))
    return joined.select("user_id", n.alias("n_vectors"), added.alias("total"))


def advance(spark: SparkSession, segments_dir: str, vectors: DataFrame, state_dir: str, iteration: int, min_rating: int = MIN_LIKED_RATING) -> DataFrame:
    """Write the sums of ``iteration`` from those of the iteration before and the new ratings; returns them
    as ``(iteration, user_id, n_vectors, total)``."""
    sums = partial_sums(segment_ratings(spark, segments_dir, iteration), vectors, min_rating)
    if iteration > 0:
        before = spark.read.parquet(state_dir).where(F.col("iteration") == iteration - 1)
        sums = merge_sums(before.select("user_id", "n_vectors", "total"), sums)
    sinks.write_state(sums.withColumn("iteration", F.lit(iteration)), state_dir)
    return spark.read.parquet(state_dir).where(F.col("iteration") == iteration)


def taste_of(sums: DataFrame) -> DataFrame:
    """``(iteration, user_id, n_vectors, embedding)``: unit vectors of the means."""
    mean = F.transform("total", lambda x: x / F.col("n_vectors"))
    return sums.select("iteration", "user_id", "n_vectors", mean.alias("__m")).select("iteration", "user_id", "n_vectors", l2_normalize("__m").alias("embedding"))
