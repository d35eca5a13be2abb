"""Item text -> vector.

The surveyed job encodes ``title: genres`` with a sentence-transformer model that
is not available offline. Here the text becomes hashed TF-IDF: a token's md5 prefix
modulo the width is its place, so the vectors do not depend on the engine. All
of it is aggregates: document frequencies have at most ``dim`` rows. ``latent_text`` goes on
to latent factors of the term matrix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.functions.scalar import item_text
from urbanlens.functions.vectors import l2_normalize
from urbanlens.operators.factors import latent_factors
from urbanlens.session import cut_lineage


def with_item_text(catalogue: DataFrame) -> DataFrame:
    return catalogue.withColumn("text", item_text("title", "genres"))


def term_cells(df: DataFrame, text_col: str = "text", dim: int = 64, key: str = "item_id") -> DataFrame:
    """``(key, cells array<struct<at:int,w:double>>)``: tf * (ln((N + 1) / (df + 1)) + 1) by place, for
    texts with tokens."""
    tokens = F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")
    place = F.conv(F.substring(F.md5("__token"), 1, 8), 16, 10).cast("bigint") % dim
    counts = df.select(F.col(key), F.explode(tokens).alias("__token")).groupBy(key, place.cast("int").alias("__at")).agg(
        F.count(F.lit(1)).alias("__tf")
    )
    n = F.lit(df.count())
    idf = counts.groupBy("__at").agg((F.log((n + 1) / (F.count(F.lit(1)) + 1)) + 1).alias("__idf"))  # dim rows
    return counts.join(F.broadcast(idf), "__at").groupBy(key).agg(
        F.collect_list(F.struct(F.col("__at").alias("at"), (F.col("__tf") * F.col("__idf")).alias("w"))).alias("cells")
    )


def embed_text(df: DataFrame, text_col: str = "text", dim: int = 64, key: str = "item_id") -> DataFrame:
    """``(key, embedding array<double>)``: ``term_cells`` as unit vectors (zeros for a text without tokens)."""
    cells = term_cells(df, text_col, dim, key).select(key, F.map_from_entries("cells").alias("__cells"))
    wide = F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)),
        lambda i: F.coalesce(F.try_element_at(F.col("__cells"), i), F.lit(0.0)),
    )
    # a row per item on both sides: neither is broadcast, whatever its guessed size
    return df.select(key).join(cells.hint("merge"), key, "left").select(key, wide.alias("__v")).select(key, l2_normalize("__v").alias("embedding"))


def latent_text(df: DataFrame, text_col: str = "text", dim: int = 512, rank: int = 64, key: str = "item_id") -> DataFrame:
    """``(key, embedding array<double>)``: unit vectors of the texts' latent factors (randomized SVD of the term
    matrix): texts whose words occur in the same company are near, also without a word in common."""
    cells = cut_lineage(term_cells(df, text_col, dim, key))
    found = latent_factors(cells, dim, rank, key)
    none = F.transform(F.sequence(F.lit(1), F.lit(rank)), lambda _: F.lit(0.0))
    return df.select(key).join(found, key, "left").select(key, l2_normalize(F.coalesce("embedding", none)).alias("embedding"))
