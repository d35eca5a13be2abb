"""Connected components of an edge table, as a loop of Spark joins.

Each round hooks every node to its smallest neighbour (or itself), renames the
edges by that choice and drops loops and repeats; each round's mapping is a table
in the shared folder. Nothing but the number of remaining edges reaches the
driver. Node ids should be hash-like (fingerprints are), so rounds stay few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(src, dst)`` to ``(node, root)`` for every node of an edge; equal
    ``root`` means connected. Loops, NULLs and repeated edges are harmless; no edges give no rows."""
    spark = edges.sparkSession

    def tidy(e: DataFrame) -> DataFrame:
        return materialize(e.where("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct())

    left = tidy(edges)
    labels = None
    while left.limit(1).count():
        both = left.select(F.col("src").alias("node"), F.col("dst").alias("other")).unionByName(left.select(F.col("dst").alias("node"), F.col("src").alias("other")))
        hook = materialize(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("root")))
        labels = hook if labels is None else materialize(
            labels.withColumnRenamed("root", "via").join(hook.select(F.col("node").alias("via"), F.col("root").alias("next")), "via", "left")
            .select("node", F.coalesce("next", "via").alias("root"))
        )
        to_src, to_dst = (hook.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("src", "dst"))
        left = tidy(left.join(to_src, "src").join(to_dst, "dst").select(F.col("src_root").alias("src"), F.col("dst_root").alias("dst")))
    return labels if labels is not None else spark.createDataFrame([], edges.select(F.col("src").alias("node"), F.col("src").alias("root")).schema)
