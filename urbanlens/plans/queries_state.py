"""Queries of the catalogue over incremental state, blocked scoring and latent factors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.functions.vectors import cosine, dot
from urbanlens.operators import factors, recsys, state, text, topk
from urbanlens.plans.catalog import _SAMPLED, _TASTE, Inputs, _rec_sql, register
from urbanlens.session import checkpoint_dir
from urbanlens.sources.testdata import with_views


# ---- iteration by iteration, each from its new ratings (A12, I5, P9) -----------------
def _incremental(i: Inputs) -> DataFrame:
    """Sums of the last iteration's and all earlier states, built by reading each segment once."""
    root = f"{checkpoint_dir(i.spark)}/incremental-{uuid.uuid4().hex}"
    state.write_segments(i.ratings, i.slices, f"{root}/ratings")
    for iteration in range(i.slices.n):
        state.advance(i.spark, f"{root}/ratings", i.vectors, f"{root}/state", iteration)
    return i.spark.read.parquet(f"{root}/state")


@register("incremental_taste_vectors", _rec_sql("""
SELECT t.iteration, t.user_id, t.n_vectors, CAST(t.dim - 1 AS INTEGER) AS dim, round(t.value, 6) AS value
FROM taste t JOIN sampled s USING (iteration, user_id)""", _SAMPLED, _TASTE))
def _incremental_taste(i: Inputs) -> DataFrame:
    sampled = recsys.sample_users(i.ratings, i.slices)
    found = state.taste_of(_incremental(i)).join(sampled.select("iteration", "user_id"), ["iteration", "user_id"], "left_semi")
    return found.select("iteration", "user_id", "n_vectors", F.posexplode("embedding").alias("dim", "value")).withColumn("value", F.round("value", 6))


# ---- top items of every stored user (C9, F4, G2) ------------------------------------
@register("recommend_all_users", _rec_sql("""
SELECT iteration, user_id, CAST(rank AS INTEGER) AS rank, item_id, round(sim, 6) AS sim FROM (
  SELECT u.iteration, u.user_id, v.item_id, list_cosine_similarity(u.user_vec, CAST(v.embedding AS DOUBLE[])) AS sim,
         row_number() OVER (PARTITION BY u.iteration, u.user_id ORDER BY list_cosine_similarity(u.user_vec, CAST(v.embedding AS DOUBLE[])) DESC, v.item_id) AS rank
  FROM (SELECT t.iteration, t.user_id, list(t.value ORDER BY t.dim) AS user_vec FROM taste t JOIN sampled s USING (iteration, user_id) GROUP BY t.iteration, t.user_id) u,
       vectors v
  WHERE NOT EXISTS (SELECT 1 FROM cum c WHERE c.iteration = u.iteration AND c.user_id = u.user_id AND c.item_id = v.item_id))
WHERE rank <= 5""", _SAMPLED, _TASTE))
def _recommend_all(i: Inputs) -> DataFrame:
    users = recsys.user_state(i.ratings, i.vectors, i.slices).select("iteration", "user_id", "embedding")
    return recsys.recommend_all(users, i.ratings, i.vectors, i.slices).withColumn("sim", F.round("sim", 6))


# ---- cosine of two vectors (I3) -----------------------------------------------------------
@register("cosine_of_neighbours", with_views("""
SELECT a.item_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS sim
FROM vectors a JOIN vectors b ON b.item_id = a.item_id + 1""", "vectors"))
def _neighbours(i: Inputs) -> DataFrame:
    after = i.vectors.select((F.col("item_id") - 1).alias("item_id"), F.col("embedding").alias("next"))
    return i.vectors.join(after, "item_id").select("item_id", F.round(cosine("embedding", "next"), 6).alias("sim"))


# ---- latent factors (I1) ---------------------------------------------------------------
_DIM = 64
_CELLS = [f"""tok AS (
  SELECT item_id, unnest(string_split_regex(lower(title || ': ' || replace(genres, '|', ' ')), '[^\\p{{L}}\\p{{N}}]+')) AS t FROM movies
),
tf AS (
  SELECT item_id, CAST(CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % {_DIM} AS INTEGER) AS place, count(*) AS tf
  FROM tok WHERE t <> '' GROUP BY ALL
),
idf AS (SELECT place, ln(((SELECT count(*) FROM movies) + 1) / (count(*) + 1)) + 1 AS idf FROM tf GROUP BY place),
cells AS (SELECT tf.item_id, tf.place, tf.tf * idf.idf AS w FROM tf JOIN idf USING (place))"""]


@register("term_gram_matrix", with_views(
    "SELECT a.place AS at, b.place AS other, round(sum(a.w * b.w), 4) AS product FROM cells a JOIN cells b USING (item_id) GROUP BY a.place, b.place", "movies", extra_ctes=_CELLS))
def _gram(i: Inputs) -> DataFrame:
    found = factors.gram(text.term_cells(text.with_item_text(i.movies), dim=_DIM), _DIM)
    return found.select("at", F.posexplode("products").alias("other", "product")).where("product <> 0").withColumn("product", F.round("product", 4))


# With as many factors as terms nothing is lost: products of factors are products of the term rows.
@register("latent_products", with_views("""
SELECT a.item_id, round(sum(a.w * b.w), 4) AS product FROM cells a JOIN cells b ON b.item_id = a.item_id + 1 AND b.place = a.place GROUP BY a.item_id""", "movies", extra_ctes=_CELLS))
def _latent(i: Inputs) -> DataFrame:
    found = factors.latent_factors(text.term_cells(text.with_item_text(i.movies), dim=_DIM), _DIM, _DIM)
    after = found.select((F.col("item_id") - 1).alias("item_id"), F.col("embedding").alias("next"))
    return found.join(after, "item_id").select("item_id", F.round(dot("embedding", "next"), 4).alias("product")).where("abs(product) > 1e-9")


@register("latent_item_vectors")
def _latent_vectors(i: Inputs) -> DataFrame:
    return text.latent_text(text.with_item_text(i.movies))
