"""Tree models checked from outside (M2, M4, M5): the saved node table is read as data and rows are routed through it.

A saved tree model is a folder of Parquet: one row per node (its value, children, split) and one per tree (its weight).
``routed`` sends every row down every tree with column expressions only, without the library's ``transform``, so the
two predictions can be compared. The trees' nodes are literals of the plan (a model's size, at most
``MAX_NODES``); rows are neither shuffled nor joined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.operators.ml import FEATURES_COL

MAX_NODES = 1 << 17  # of a whole model; beyond, its nodes are no literals of a plan


@dataclass(frozen=True)
class Node:
    value: float
    feature: int  # -1 in a leaf
    threshold: float  # rows at most this go left
    left: int
    right: int
    n_rows: int  # training rows that reached it


@dataclass(frozen=True)
class Tree:
    weight: float
    nodes: tuple[Node, ...]  # by id; 0 is the root

    def depth(self) -> int:
        deep, level = 0, [0]
        while level := [c for i in level if self.nodes[i].feature >= 0 for c in (self.nodes[i].left, self.nodes[i].right)]:
            deep += 1
        return deep


def read_trees(spark: SparkSession, path: str) -> list[Tree]:
    """The trees of a saved boosted or forest model, in order."""
    table = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    if table.count() > MAX_NODES:
        raise ValueError(f"{path}: more than {MAX_NODES} nodes")
    nodes: dict[int, dict[int, Node]] = {}
    for r in table.collect():  # bounded by the check above
        if r["leftChild"] >= 0 and r["split"]["numCategories"] != -1:
            raise ValueError(f"tree {r['treeID']}, node {r['id']}: a categorical split")
        inner = r["leftChild"] >= 0
        nodes.setdefault(r["treeID"], {})[r["id"]] = Node(
            r["prediction"],
            r["split"]["featureIndex"] if inner else -1,
            r["split"]["leftCategoriesOrThreshold"][0] if inner else 0.0,
            r["leftChild"],
            r["rightChild"],
            r["rawCount"],
        )
    weights = {r[0]: r[2] for r in spark.read.parquet(f"{path}/treesMetadata").collect()}  # one row a tree
    return [Tree(float(weights[t]), tuple(nodes[t][i] for i in range(len(nodes[t])))) for t in sorted(nodes)]


def _array(values: list, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def leaf_of(tree: Tree, features: str = "_features") -> Column:
    """The id of the leaf that a row's array of features reaches: one comparison per level."""
    feature, threshold = _array([n.feature for n in tree.nodes], "int"), _array([n.threshold for n in tree.nodes], "double")
    left, right = _array([n.left for n in tree.nodes], "int"), _array([n.right for n in tree.nodes], "int")

    def step(node: Column, _: Column) -> Column:
        at = F.get(feature, node)
        down = F.when(F.get(features, at) <= F.get(threshold, node), F.get(left, node)).otherwise(F.get(right, node))
        return F.when(at < 0, node).otherwise(down)

    depth = tree.depth()
    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step) if depth else F.lit(0)


def routed(df: DataFrame, trees: list[Tree], mean: bool, features: str = FEATURES_COL) -> DataFrame:
    """``df`` with ``leaves`` (the leaf of every tree) and ``routed_prediction``: the weighted sum of the leaves' values (boosted
    trees), or over the weights' sum (``mean``: a forest)."""
    reached = df.withColumn("_features", vector_to_array(features, "float64")).withColumn("leaves", F.array(*[leaf_of(t) for t in trees]))
    total = F.lit(0.0)
    for i, t in enumerate(trees):
        total = total + F.get(_array([n.value for n in t.nodes], "double"), F.get("leaves", F.lit(i))) * t.weight
    if mean:
        total = total / sum(t.weight for t in trees)
    return reached.withColumn("routed_prediction", total).drop("_features")


def same(a: str, b: str, tolerance: float = 1e-9) -> Column:
    """Whether two numbers are equal up to the order of a sum."""
    return F.abs(F.col(a) - F.col(b)) <= tolerance * F.greatest(F.lit(1.0), F.abs(F.col(a)))


def compare_routes(scored: DataFrame, trees: list[Tree], mean: bool) -> DataFrame:
    """One row: n, n_equal: scored rows (``features``, ``prediction``), and those whose route gives the same prediction."""
    both = routed(scored, trees, mean).withColumn("ok", same("prediction", "routed_prediction"))
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("n_equal"))


def first_tree_leaves(train: DataFrame, trees: list[Tree], label: str) -> DataFrame:
    """``leaf, value, counted, n, mean_label`` of every leaf of a boosted model's first tree, which is fitted to the labels
    themselves: its training rows by their routes and by the model's own count, its value and the mean of their labels."""
    first = trees[0]
    leaves = [(i, n.value, n.n_rows) for i, n in enumerate(first.nodes) if n.feature < 0]
    stored = train.sparkSession.createDataFrame(leaves, "leaf int, value double, counted long")
    reached = routed(train, [first], mean=False).groupBy(F.get("leaves", F.lit(0)).alias("leaf"))
    return stored.join(reached.agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("mean_label")), "leaf", "left")
