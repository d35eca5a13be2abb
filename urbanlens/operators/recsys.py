"""Recommendation operators over cumulative time slices (B15, B16, C5–C9, C11,
D18–D21, F3, F4, G1, G2, I2–I5).

Iteration ``i`` sees every rating from the first day up to its last day; the slices
are nested. Instead of joining the ratings against the bounds (which copies every
rating once per iteration), each rating gets the *segment* of the first slice
that contains it — a CASE expression, no join — then the data is aggregated per
segment (partial + final, so hot users/items are combined map-side), and only
those aggregates are expanded to the iterations ``segment .. n-1`` with
``explode(sequence(...))`` and summed again. Work before the expansion grows
with the ratings; after it, with (keys × iterations).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanlens.functions.scalar import day_start, epoch_to_text, round_half_even
from urbanlens.functions.vectors import dot, l2_normalize
from urbanlens.operators.sampling import pick_one, sample_keys
from urbanlens.operators.topk import top_items
from urbanlens.session import cut_lineage

# Recommendation parameters of the surveyed job.
USER_SAMPLE_FRACTION = 0.30
TOP_N = 5
TOP_USER_PERCENTILE = 95
RANDOM_SEED = 42
MIN_LIKED_RATING = 4


@dataclass(frozen=True)
class Slices:
    """Cumulative slices of whole UTC days: each starts with ``first_day`` and the
    i-th ends with ``last_days[i]`` (``None`` is open)."""

    first_day: dt.date
    last_days: tuple[dt.date | None, ...]

    @property
    def n(self) -> int:
        return len(self.last_days)

    def segment(self, ts: Column) -> Column:
        """Index of the first slice containing epoch second ``ts`` (NULL when none does)."""
        expr = None
        for i, day in enumerate(self.last_days):
            inside = F.lit(True) if day is None else (ts < day_start(day, 1))
            expr = F.when(inside, i) if expr is None else expr.when(inside, i)
        return F.when(ts >= day_start(self.first_day), expr)


def assign_segment(ratings: DataFrame, slices: Slices, ts: str = "ts") -> DataFrame:
    return ratings.withColumn("segment", slices.segment(F.col(ts))).filter(F.col("segment").isNotNull())


def expand_iterations(df: DataFrame, slices: Slices, segment: str = "segment") -> DataFrame:
    """Copy each row to the iterations ``segment .. n-1`` (C11 without a join)."""
    return df.withColumn("iteration", F.explode(F.sequence(F.col(segment), F.lit(slices.n - 1)))).drop(segment)


def slice_summary(ratings: DataFrame, slices: Slices) -> DataFrame:
    """Per iteration: ratings, distinct users, distinct items, first/last ts.

    Distinct keys are counted from each key's first iteration (one aggregate per
    key), then every count is one global conditional aggregate per iteration.
    """
    seg = assign_segment(ratings, slices)
    rows = cumulative_aggregate(
        seg, [], slices,
        {"n_ratings": ("count", None), "first_ts": ("min", "ts"), "last_ts": ("max", "ts")},
    )
    firsts = {
        k: first_iteration(seg, k, slices).withColumnRenamed("iteration", "segment") for k in ("user_id", "item_id")
    }
    n_users = cumulative_aggregate(firsts["user_id"], [], slices, {"n_users": ("count", None)})
    n_items = cumulative_aggregate(firsts["item_id"], [], slices, {"n_items": ("count", None)})
    # each side holds one row per iteration: broadcast is size-safe
    return rows.join(F.broadcast(n_users), "iteration").join(F.broadcast(n_items), "iteration")


def first_iteration(seg: DataFrame, key: str, slices: Slices) -> DataFrame:
    """``(key, iteration)`` of the first iteration in which each key appears (G1)."""
    return seg.groupBy(key).agg(F.min("segment").alias("iteration"))


def new_keys(ratings: DataFrame, slices: Slices, key: str = "user_id") -> DataFrame:
    """Keys new in iteration i: present in slice i, absent from slice i-1."""
    return first_iteration(assign_segment(ratings, slices), key, slices).select("iteration", key)


def iteration_keys(ratings: DataFrame, slices: Slices, key: str = "user_id") -> DataFrame:
    """``(iteration, key)`` for every key present in each cumulative slice."""
    first = first_iteration(assign_segment(ratings, slices), key, slices)
    return expand_iterations(first.withColumnRenamed("iteration", "segment"), slices)


def cumulative_aggregate(
    seg: DataFrame, keys: Sequence[str], slices: Slices, aggs: dict[str, tuple[str, str | None]]
) -> DataFrame:
    """Per key and iteration, aggregates over the cumulative slice, in ONE shuffle.

    The iteration count is known when the plan is built, so each output is one
    conditional aggregate per iteration (``segment <= i``), computed by a single
    hash aggregate on ``keys`` (partial phase per task: a hot key is combined
    map-side); the per-iteration columns are then unpivoted without a shuffle.
    ``aggs``: output name -> (function, column); functions: ``count`` (rows),
    ``count_col`` (non-NULL values), ``sum``, ``min``, ``max``.
    Rows for iterations in which the key has no data are dropped.
    """
    cols = []
    for i in range(slices.n):
        inside = F.col("segment") <= i
        for name, (fn, col) in aggs.items():
            if fn == "count":
                expr = F.count_if(inside)
            elif fn == "count_col":
                expr = F.count(F.when(inside, F.col(col)))
            elif fn == "sum":
                expr = F.sum(F.when(inside, F.col(col)))
            elif fn == "min":
                expr = F.min(F.when(inside, F.col(col)))
            elif fn == "max":
                expr = F.max(F.when(inside, F.col(col)))
            else:
                raise ValueError(f"unsupported aggregate {fn!r}")
            cols.append(expr.alias(f"__{name}_{i}"))
    wide = seg.groupBy(*keys).agg(*cols)
    per_it = F.array(*[
        F.struct(F.lit(i).alias("iteration"), *[F.col(f"__{name}_{i}").alias(name) for name in aggs])
        for i in range(slices.n)
    ])
    first = next(name for name, (fn, _) in aggs.items() if fn == "count")
    return (
        wide.select(*keys, F.explode(per_it).alias("__it"))
        .select("__it.iteration", *keys, *[F.col(f"__it.{name}").alias(name) for name in aggs])
        .filter(F.col(first) > 0)
    )


def popularity(ratings: DataFrame, slices: Slices, catalogue: DataFrame | None = None) -> DataFrame:
    """``(iteration, item_id, n_ratings)``; restricted to catalogue items."""
    pop = cumulative_aggregate(assign_segment(ratings, slices), ["item_id"], slices, {"n_ratings": ("count", None)})
    if catalogue is not None:  # after aggregating: joins per-item rows, not ratings
        pop = pop.join(catalogue.select("item_id"), "item_id", "left_semi")
    return pop


def top_per_group(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int, rank_alias: str = "rank"
) -> DataFrame:
    """Top ``n`` rows per group. ``row_number() <= n`` plans a partial
    ``WindowGroupLimit`` before the shuffle, so each task forwards at most ``n``
    rows per group."""
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank_alias, F.row_number().over(w)).filter(F.col(rank_alias) <= n)


def cold_recommendations(
    ratings: DataFrame, catalogue: DataFrame, slices: Slices, n: int = TOP_N
) -> DataFrame:
    """Most-rated catalogue items per iteration (ties: smaller item id first)."""
    pop = popularity(ratings, slices, catalogue)
    top = top_per_group(pop, ["iteration"], [F.desc("n_ratings"), F.asc("item_id")], n)
    return top.join(catalogue.select("item_id", "title"), "item_id").select(
        "iteration", "rank", "item_id", "title", "n_ratings"
    )


def user_counts(ratings: DataFrame, slices: Slices) -> DataFrame:
    """``(iteration, user_id, n_ratings, rating_sum, last_ts)`` per cumulative slice."""
    return cumulative_aggregate(
        assign_segment(ratings, slices),
        ["user_id"],
        slices,
        {"n_ratings": ("count", None), "rating_sum": ("sum", "rating"), "last_ts": ("max", "ts")},
    )


def user_stats(ratings: DataFrame, slices: Slices, digits: int = 2) -> DataFrame:
    """Last interaction (text), rating count and mean rating rounded half-even
    on the double (D20, H12)."""
    return user_counts(ratings, slices).select(
        "iteration",
        "user_id",
        epoch_to_text(F.col("last_ts")).alias("last_interaction_time"),
        F.col("n_ratings").alias("num_ratings"),
        round_half_even(F.col("rating_sum") / F.col("n_ratings"), digits).alias("avg_rating"),
    )


def top_users(ratings: DataFrame, slices: Slices, percentile: float = TOP_USER_PERCENTILE) -> DataFrame:
    """Users whose rating count reaches the per-iteration percentile (linear
    interpolation). The percentile buffer holds one entry per distinct count."""
    counts = user_counts(ratings, slices)
    thr = counts.groupBy("iteration").agg(
        F.percentile(F.col("n_ratings"), percentile / 100.0).alias("threshold")
    )
    return (
        counts.join(F.broadcast(thr), "iteration")  # one row per iteration
        .filter(F.col("n_ratings") >= F.col("threshold"))
        .select("iteration", "user_id", "n_ratings", "threshold")
    )


def pick_top_user(ratings: DataFrame, slices: Slices, seed: int = RANDOM_SEED) -> DataFrame:
    """One user per iteration among the top users (smallest md5 of ``seed:user``)."""
    return pick_one(top_users(ratings, slices), "user_id", seed, groups=["iteration"])


def sample_users(
    ratings: DataFrame, slices: Slices, fraction: float = USER_SAMPLE_FRACTION, seed: int = RANDOM_SEED
) -> DataFrame:
    """Exact-size user sample per iteration, md5 seed ``seed + iteration``."""
    keys = iteration_keys(ratings, slices, "user_id")  # one row per (iteration, user) by construction
    return sample_keys(keys, "user_id", fraction, seed, groups=["iteration"], seed_offset="iteration",
                       assume_distinct=True)


def liked_with_vectors(
    ratings: DataFrame, vectors: DataFrame, slices: Slices, min_rating: int = MIN_LIKED_RATING
) -> DataFrame:
    """Per iteration and user: liked ratings and how many of them have a vector."""
    liked = assign_segment(ratings.filter(F.col("rating") >= min_rating), slices)
    has_vec = vectors.select("item_id").withColumn("__v", F.lit(1))
    return cumulative_aggregate(
        liked.join(has_vec, "item_id", "left"), ["user_id"], slices,
        {"n_liked": ("count", None), "n_liked_with_vector": ("count_col", "__v")},
    )


def taste_vectors(
    ratings: DataFrame,
    vectors: DataFrame,
    slices: Slices,
    min_rating: int = MIN_LIKED_RATING,
    users: DataFrame | None = None,
) -> DataFrame:
    """Normalised mean vector of each user's liked items per iteration (I4).

    Users without any liked item that has a vector are absent. Likes are counted per
    (segment, user, item) first, so a very popular item enters the join once a user; the
    weighted vector sums are a vector aggregate of any width with a partial phase per task, and
    fail on vectors of different widths. ``users`` (iteration, user_id) restricts the
    work to those users before any aggregation.
    """
    liked = ratings.filter(F.col("rating") >= min_rating)
    if users is not None:
        liked = liked.join(users.select("user_id").distinct(), "user_id", "left_semi")
    known = vectors.where("embedding is not null")
    liked = liked.join(known.select("item_id"), "item_id", "left_semi")  # others add nothing
    times = assign_segment(liked, slices).groupBy("segment", "user_id", "item_id").agg(F.count(F.lit(1)).alias("n"))
    vec = known.select(
        "item_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("__v")
    )
    seg = times.join(vec, "item_id").groupBy("segment", "user_id").agg(
        F.sum("n").alias("n"), Summarizer.sum(F.col("__v"), F.col("n").cast("double")).alias("__v")
    )
    it = expand_iterations(seg, slices)
    if users is not None:
        it = it.join(users.select("iteration", "user_id"), ["iteration", "user_id"], "left_semi")
    it = it.groupBy("iteration", "user_id").agg(F.sum("n").alias("n_vectors"), Summarizer.sum(F.col("__v")).alias("__v"))
    mean = F.transform(vector_to_array("__v"), lambda x: x / F.col("n_vectors"))
    return it.select("iteration", "user_id", "n_vectors", mean.alias("__m")).select(
        "iteration", "user_id", "n_vectors", l2_normalize("__m").alias("embedding")
    )


def user_state(
    ratings: DataFrame, vectors: DataFrame, slices: Slices,
    fraction: float = USER_SAMPLE_FRACTION, seed: int = RANDOM_SEED,
) -> DataFrame:
    """Taste vectors of the sampled users per iteration (I5): the stored state."""
    sampled = sample_users(ratings, slices, fraction, seed)
    return taste_vectors(ratings, vectors, slices, users=sampled)


def seen_items(ratings: DataFrame, users: DataFrame, slices: Slices, distinct: bool = True) -> DataFrame:
    """``(iteration, user_id, item_id)`` already rated by the given per-iteration
    users (G2). ``distinct=False`` skips the de-duplication shuffle when the result only feeds an anti join."""
    u = users.select("iteration", "user_id")
    mine = assign_segment(ratings.select("user_id", "item_id", "ts"), slices)
    # a rating of segment s belongs to every iteration >= s
    out = mine.join(u, "user_id").filter(F.col("segment") <= F.col("iteration")).select(
        "iteration", "user_id", "item_id"
    )
    return out.distinct() if distinct else out


def score_items(user_vectors: DataFrame, vectors: DataFrame, slices: Slices) -> DataFrame:
    """Cosine of each iteration's user vector against every item vector.

    ``user_vectors`` holds one vector per iteration, which is checked while scoring (a second one is an
    error; ``recommend_all`` serves many users). Every vector is normalised once,
    before the items are copied to the iterations, so a pair costs one dot product;
    a zero vector has similarity 0.
    """
    items = vectors.select(
        "item_id", l2_normalize(F.col("embedding").cast("array<double>")).alias("item_vec")
    ).withColumn("iteration", F.explode(F.sequence(F.lit(0), F.lit(slices.n - 1))))
    one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("score_items takes one user per iteration"))).otherwise(F.first("user_id")).alias("user_id")
    u = user_vectors.groupBy("iteration").agg(one, l2_normalize(F.first("embedding")).alias("user_vec"))
    return items.join(u, "iteration").select(
        "iteration", "user_id", "item_id", dot("user_vec", "item_vec").alias("sim")
    )


def recommend(
    scores: DataFrame, seen: DataFrame, catalogue: DataFrame, n: int = TOP_N
) -> DataFrame:
    """Top ``n`` unseen items per (iteration, user) by similarity (C7, F4); of these,
    the ones the catalogue has (their ranks stay)."""
    unseen = scores.join(seen, ["iteration", "user_id", "item_id"], "left_anti")
    top = top_per_group(unseen, ["iteration", "user_id"], [F.desc("sim"), F.asc("item_id")], n)
    # titles come from catalogue rows only
    return top.join(catalogue.select("item_id", "title"), "item_id").select(
        "iteration", "user_id", "rank", "item_id", "title", "sim"
    )


def recommend_all(users: DataFrame, ratings: DataFrame, vectors: DataFrame, slices: Slices, n: int = TOP_N) -> DataFrame:
    """``(iteration, user_id, rank, item_id, sim)``: the top ``n`` unseen items of every stored user, by
    blocked matrix products; see ``operators.topk``."""
    # only items with a vector can take a place of a list
    rated = ratings.join(vectors.where("embedding is not null").select("item_id"), "item_id", "left_semi")
    return top_items(users.select("iteration", "user_id", "embedding"), vectors, n, lambda keys: seen_items(rated, keys, slices, distinct=False))


def user_vectors_for(
    ratings: DataFrame, vectors: DataFrame, slices: Slices, users: DataFrame,
    state: DataFrame | None = None,
) -> DataFrame:
    """Vectors of the given per-iteration users (C8): the stored state where it
    has the user, otherwise recomputed from the ratings; users without any liked
    vector stay absent (the caller falls back to popularity)."""
    recomputed = taste_vectors(ratings, vectors, slices, users=users)
    if state is None:
        return recomputed
    stored = state.select("iteration", "user_id", "n_vectors", "embedding").join(
        users.select("iteration", "user_id"), ["iteration", "user_id"], "left_semi"
    )
    missing = recomputed.join(stored.select("iteration", "user_id"), ["iteration", "user_id"], "left_anti")
    return stored.unionByName(missing)


@dataclass(frozen=True)
class Picked:
    """What the recommendations of the picked users start from, each written once
    (a user per iteration, and those few users' own ratings and vectors), so that no
    later plan scans all ratings again."""

    users: DataFrame
    ratings: DataFrame
    taste: DataFrame


def picked_users(
    ratings: DataFrame, vectors: DataFrame, slices: Slices, seed: int = RANDOM_SEED, state: DataFrame | None = None
) -> Picked:
    # min_by per iteration: one row per iteration, the proven bound of these broadcasts
    users = cut_lineage(pick_top_user(ratings, slices, seed))
    own = ratings.join(F.broadcast(users.select("user_id").distinct()), "user_id", "left_semi")
    own = cut_lineage(own.select("user_id", "item_id", "rating", "ts"))
    return Picked(users, own, cut_lineage(user_vectors_for(own, vectors, slices, F.broadcast(users), state)))


def _recommend_for(picked: Picked, vectors: DataFrame, catalogue: DataFrame, slices: Slices, n: int) -> DataFrame:
    scores = score_items(F.broadcast(picked.taste), vectors, slices)
    seen = seen_items(picked.ratings, F.broadcast(picked.users), slices, distinct=False)
    return recommend(scores, seen, catalogue, n)


def top_user_recommendations(
    ratings: DataFrame, vectors: DataFrame, catalogue: DataFrame, slices: Slices,
    n: int = TOP_N, seed: int = RANDOM_SEED, state: DataFrame | None = None,
) -> DataFrame:
    """Top ``n`` unseen items for the picked top user of each iteration."""
    return _recommend_for(picked_users(ratings, vectors, slices, seed, state), vectors, catalogue, slices, n)


def _with_fallback(picked: Picked, cold: DataFrame, vectors: DataFrame, catalogue: DataFrame, slices: Slices, n: int) -> DataFrame:
    top = _recommend_for(picked, vectors, catalogue, slices, n)
    without = picked.users.join(F.broadcast(picked.taste.select("iteration")), "iteration", "left_anti")
    fallback = cold.join(F.broadcast(without), "iteration").select("iteration", "user_id", "rank", "item_id", "title")
    cold_rows = cold.select(
        "iteration", F.lit("cold").alias("user_type"), F.lit(None).cast("bigint").alias("user_id"),
        "rank", "item_id", "title",
    )
    top_rows = top.select("iteration", "user_id", "rank", "item_id", "title").unionByName(fallback)
    return cold_rows.unionByName(
        top_rows.select("iteration", F.lit("top").alias("user_type"), "user_id", "rank", "item_id", "title")
    )


def recommendations_with_fallback(
    ratings: DataFrame, vectors: DataFrame, catalogue: DataFrame, slices: Slices,
    n: int = TOP_N, seed: int = RANDOM_SEED, state: DataFrame | None = None,
) -> DataFrame:
    """Cold-user rows plus top-user rows per iteration.

    The top user's vector is its stored or recomputed taste vector. Only a user
    without any vector gets the popularity list; one with a vector who has seen
    everything gets no rows.
    """
    picked = picked_users(ratings, vectors, slices, seed, state)
    cold = cut_lineage(cold_recommendations(ratings, catalogue, slices, n))  # n rows per iteration
    return _with_fallback(picked, cold, vectors, catalogue, slices, n)


def recommendation_documents(
    ratings: DataFrame, vectors: DataFrame, catalogue: DataFrame, slices: Slices,
    generated_at: str, n: int = TOP_N, seed: int = RANDOM_SEED, state: DataFrame | None = None,
) -> DataFrame:
    """Result documents: one cold and one top row per iteration, titles as an
    array in rank order (empty when there is nothing to recommend)."""
    picked = picked_users(ratings, vectors, slices, seed, state)
    cold = cut_lineage(cold_recommendations(ratings, catalogue, slices, n))
    recs = _with_fallback(picked, cold, vectors, catalogue, slices, n)
    lists = recs.groupBy("iteration", "user_type").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "title"))), lambda s: s["title"]
        ).alias("Recommendations")
    )
    kinds = F.explode(F.array(F.lit("cold"), F.lit("top"))).alias("user_type")
    stats = user_stats(picked.ratings, slices).withColumn("user_type", F.lit("top"))
    docs = (
        picked.users.select("iteration", "user_id", kinds)
        .join(lists, ["iteration", "user_type"], "left")
        .join(stats, ["iteration", "user_id", "user_type"], "left")
    )
    return docs.select(
        F.col("user_type").alias("User_Type"),
        F.col("last_interaction_time").alias("Last_Interaction_Time"),
        F.coalesce(F.col("num_ratings"), F.lit(0)).alias("Num_Ratings"),
        F.col("avg_rating").alias("Avg_Rating"),
        F.coalesce("Recommendations", F.array().cast("array<string>")).alias("Recommendations"),
        "iteration",
        F.lit(generated_at).alias("generated_at"),
    )
