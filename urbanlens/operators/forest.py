"""Tree ensembles as data and as expressions.

A forest is a table of nodes: ``(tree, node, feature, threshold, categories, below,
above, prediction)``. An inner node sends a row to ``below`` if its feature is at most
``threshold`` (or among ``categories``, for a categorical split) and to ``above`` otherwise; a leaf
has no feature. ``node_table`` reads the nodes of a fitted and saved ``pyspark.ml``
forest, which is itself a table of nodes, so a model can be inspected, stored, compared
and scored wherever SQL runs.

``prediction`` compiles a forest to one Column. Small forests become nested CASE
expressions, which are generated code; ``prediction_by_lookup`` walks constant arrays instead,
a step per level, so that the size of the expression is the same for any forest.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "tree int, node int, feature int, threshold double, categories array<double>, below int, above int, prediction double"


@dataclass(frozen=True)
class Node:
    tree: int
    node: int
    prediction: float
    feature: int | None = None
    threshold: float | None = None
    categories: tuple[float, ...] | None = None
    below: int | None = None
    above: int | None = None

    @property
    def leaf(self) -> bool:
        return self.feature is None


def node_table(spark: SparkSession, model_dir: str, stage: int | None = None) -> DataFrame:
    """Nodes of the forest saved in ``model_dir``: a forest's own folder, or stage number
    ``stage`` of a saved pipeline (the last by default)."""
    path = model_dir
    jvm = spark.sparkContext._jvm
    stages = jvm.org.apache.hadoop.fs.Path(f"{model_dir}/stages")
    fs = stages.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(stages):
        names = sorted((x.getPath().getName() for x in fs.listStatus(stages)), key=lambda n: int(n.split("_")[0]))
        path = f"{model_dir}/stages/{names[-1 if stage is None else stage]}"
    saved = spark.read.parquet(f"{path}/data")
    # older files hold the node as a struct beside the tree's number
    node = F.col("nodeData") if "nodeData" in saved.columns else F.struct(*[c for c in saved.columns if c != "treeID"])
    rows = saved.select(F.col("treeID").cast("int").alias("tree"), node.alias("n"))
    split, leaf = F.col("n.split"), F.col("n.leftChild") < 0
    ordered = split["numCategories"] < 0
    return rows.select(
        "tree", F.col("n.id").cast("int").alias("node"),
        F.when(~leaf, split["featureIndex"]).cast("int").alias("feature"),
        F.when(~leaf & ordered, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(~leaf & ~ordered, split["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(~leaf, F.col("n.leftChild")).cast("int").alias("below"),
        F.when(~leaf, F.col("n.rightChild")).cast("int").alias("above"),
        F.col("n.prediction").alias("prediction"),
    )


def to_frame(spark: SparkSession, nodes: Iterable[Node]) -> DataFrame:
    rows = [(n.tree, n.node, n.feature, n.threshold, None if n.categories is None else list(n.categories), n.below, n.above, n.prediction) for n in nodes]
    return spark.createDataFrame(rows, SCHEMA)


def from_frame(nodes: DataFrame) -> list[Node]:
    """Nodes on the driver: a model is as large as its trees, whatever the data's size."""
    return [
        Node(r.tree, r.node, r.prediction, r.feature, r.threshold, None if r.categories is None else tuple(r.categories), r.below, r.above)
        for r in nodes.orderBy("tree", "node").collect()
    ]


def check(nodes: Sequence[Node]) -> dict[int, dict[int, Node]]:
    """Nodes by tree and number. Every tree must be one: rooted at 0, each child reached once."""
    trees: dict[int, dict[int, Node]] = {}
    for n in nodes:
        if trees.setdefault(n.tree, {}).setdefault(n.node, n) is not n:
            raise ValueError(f"tree {n.tree} has two nodes {n.node}")
    for number, tree in trees.items():
        todo, seen = [0], set()
        while todo:
            at = todo.pop()
            if at not in tree or at in seen:
                raise ValueError(f"tree {number} is broken at node {at}")
            seen.add(at)
            n = tree[at]
            if not n.leaf:
                if (n.threshold is None) == (n.categories is None) or n.below is None or n.above is None:
                    raise ValueError(f"tree {number}, node {at}: one split and two children are needed")
                todo += [n.below, n.above]
        if len(seen) != len(tree):
            raise ValueError(f"tree {number} has nodes that are not reached")
    return trees


def depth(nodes: Sequence[Node]) -> int:
    deepest = 0
    for tree in check(nodes).values():
        todo = [(0, 0)]
        while todo:
            at, d = todo.pop()
            deepest = max(deepest, d)
            if not tree[at].leaf:
                todo += [(tree[at].below, d + 1), (tree[at].above, d + 1)]
    return deepest


def tree_case(tree: dict[int, Node], inputs: Sequence[Column], at: int = 0) -> Column:
    """One tree as nested CASE expressions. A NULL or NaN input goes above."""
    n = tree[at]
    if n.leaf:
        return F.lit(float(n.prediction))
    x = inputs[n.feature]
    goes_below = x <= F.lit(n.threshold) if n.categories is None else x.isin(*[float(c) for c in n.categories]) if n.categories else F.lit(False)
    return F.when(goes_below, tree_case(tree, inputs, n.below)).otherwise(tree_case(tree, inputs, n.above))


def prediction(nodes: Sequence[Node], inputs: Sequence[Column]) -> Column:
    """Mean of the trees' predictions; ``inputs`` are doubles in the order of the feature numbers."""
    trees = check(nodes)
    if not trees:
        raise ValueError("a forest without trees predicts nothing")
    total = F.lit(0.0)
    for number in sorted(trees):
        total = total + tree_case(trees[number], inputs)
    return total / float(len(trees))


def prediction_by_lookup(nodes: Sequence[Node], features: Column) -> Column:
    """The same for a forest of any size; ``features`` is an array of doubles. Nodes of all trees stand one after the
    other in constant arrays; each of ``depth`` steps moves every tree's place to a child (a leaf is its own)."""
    trees = check(nodes)
    flat = [trees[t][n] for t in sorted(trees) for n in sorted(trees[t])]
    place = {(n.tree, n.node): i for i, n in enumerate(flat)}
    feature = F.lit([0 if n.leaf else n.feature for n in flat])
    # ordered splits compare; categorical ones hold a set, an empty one for all others
    threshold = F.lit([float("-inf") if n.leaf or n.threshold is None else float(n.threshold) for n in flat])
    categories = F.array(*[F.array(*[F.lit(float(c)) for c in n.categories or ()]).cast("array<double>") for n in flat]) if any(n.categories for n in flat) else None
    below = F.lit([place[n.tree, n.node if n.leaf else n.below] for n in flat])
    above = F.lit([place[n.tree, n.node if n.leaf else n.above] for n in flat])
    value = F.lit([float(n.prediction) for n in flat])

    def move(at: Column) -> Column:
        x = F.get(features, F.get(feature, at))
        goes_below = x <= F.get(threshold, at)
        if categories is not None:
            goes_below = goes_below | F.array_contains(F.get(categories, at), x)
        return F.when(goes_below, F.get(below, at)).otherwise(F.get(above, at))

    roots = F.lit([place[t, 0] for t in sorted(trees)])
    leaves = F.transform(roots, lambda root: F.aggregate(F.sequence(F.lit(1), F.lit(max(1, depth(nodes)))), root, lambda at, _: move(at)))
    return F.aggregate(leaves, F.lit(0.0), lambda s, at: s + F.get(value, at)) / float(len(trees))


def nodes_sql(nodes: Sequence[Node]) -> str:
    """The node table as SQL rows ``(tree, node, feature, threshold, categories, below, above, prediction)``."""
    show = lambda x: "NULL" if x is None else repr(float(x)) + "::DOUBLE" if isinstance(x, float) else str(x)
    rows = []
    for n in nodes:
        among = "NULL" if n.categories is None else "[" + ", ".join(f"{float(c)}::DOUBLE" for c in n.categories) + "]"
        rows.append(f"({n.tree}, {n.node}, {show(n.feature)}, {show(n.threshold)}, {among}, {show(n.below)}, {show(n.above)}, {show(float(n.prediction))})")
    return "(VALUES " + ", ".join(rows) + ") AS nodes(tree, node, feature, threshold, categories, below, above, prediction)"
