"""Exact attributions for ensembles of decision trees, from their nodes.

A feature set's value is what a tree is expected to give when only these features are known: unknown splits weigh
their sides by training rows. The shares are the Shapley values of that game (Lundberg et al., 2020), summed leaf by
leaf: a leaf's part depends only on which of the features on its path let the row through, so each such pattern is worked out once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NODE_KIND = "tree int, node int, feature int, threshold double, categories array<double>, left int, right int, cover double, value double"
ROWS_AT_ONCE = 4096


@dataclass(frozen=True)
class Node:
    """A split (``feature`` with the threshold up to which, or the categories for which, rows go left) or a leaf."""

    tree: int
    node: int
    feature: int | None
    threshold: float | None
    categories: tuple[float, ...] | None
    left: int | None
    right: int | None
    cover: float
    value: float


def model_nodes(model) -> list[Node]:
    """Nodes of a fitted tree, boosted trees or a regression forest; values already carry the tree's weight."""
    trees = list(getattr(model, "trees", [model]))
    weights = [float(w) for w in getattr(model, "treeWeights", [1.0])]
    if type(model).__name__.startswith("RandomForest"):
        if "Classification" in type(model).__name__:
            raise ValueError("forests of classifiers vote on probabilities and have no margin to share out")
        weights = [w / sum(weights) for w in weights]
    found: list[Node] = []
    for number, (tree, weight) in enumerate(zip(trees, weights, strict=True)):
        waiting, used = [(tree._call_java("rootNode"), 0)], 1
        while waiting:
            java, node = waiting.pop()
            stats = java.impurityStats()
            cover = float(stats.count())
            if java.getClass().getSimpleName() == "LeafNode":
                found.append(Node(number, node, None, None, None, None, None, cover, weight * float(java.prediction())))
                continue
            split = java.split()
            continuous = split.getClass().getSimpleName() == "ContinuousSplit"
            left, right = used, used + 1
            used += 2
            found.append(Node(
                number, node, int(split.featureIndex()), float(split.threshold()) if continuous else None,
                None if continuous else tuple(float(c) for c in split.leftCategories()), left, right, cover, 0.0,
            ))
            waiting += [(java.leftChild(), left), (java.rightChild(), right)]
    return found


def node_table(nodes: Sequence[Node], spark: SparkSession) -> DataFrame:
    """The nodes as a table, to look at or to store with the model."""
    rows = [(n.tree, n.node, n.feature, n.threshold, None if n.categories is None else list(n.categories), n.left, n.right, n.cover, n.value) for n in nodes]
    return spark.createDataFrame(rows, NODE_KIND)


def nodes_of_table(table: DataFrame) -> list[Node]:
    """Nodes from their table, which is as large as the model and no larger."""
    return [Node(r["tree"], r["node"], r["feature"], r["threshold"], None if r["categories"] is None else tuple(r["categories"]), r["left"], r["right"], r["cover"], r["value"]) for r in table.collect()]


@dataclass(frozen=True)
class Leaf:
    """Value, features on the path, each one's conditions and the share of training rows that its splits let through."""

    value: float
    features: tuple[int, ...]
    conditions: tuple[tuple[tuple[float | None, tuple[float, ...] | None, bool], ...], ...]
    passing: tuple[float, ...]

    def through(self, x: np.ndarray) -> np.ndarray:
        """Per row the features that let it through, as bits."""
        bits = np.zeros(len(x), np.int64)
        for k, feature in enumerate(self.features):
            ok = np.ones(len(x), bool)
            for threshold, categories, left in self.conditions[k]:
                goes = x[:, feature] <= threshold if categories is None else np.isin(x[:, feature], categories)
                ok &= goes == left  # a missing value is not at most the threshold and goes right
            bits |= ok.astype(np.int64) << k
        return bits

    def shares(self, patterns: np.ndarray) -> np.ndarray:
        """Shapley value of every feature on the path for each pattern of features that let the row through."""
        m = len(self.features)
        one = ((patterns[:, None] >> np.arange(m)) & 1).astype(float)
        zero = np.array(self.passing)
        weights = np.array([factorial(s) * factorial(m - s - 1) / factorial(m) for s in range(m)])
        out = np.empty((len(patterns), m))
        for j in range(m):
            # coefficient s: sum over sets of s other features known, the rest averaged out
            sums = np.zeros((len(patterns), m))
            sums[:, 0] = 1.0
            for k in range(m):
                if k != j:
                    more = sums * zero[k]
                    more[:, 1:] += sums[:, :-1] * one[:, k, None]
                    sums = more
            out[:, j] = self.value * (one[:, j] - zero[j]) * (sums @ weights)
        return out


def leaves(nodes: Sequence[Node]) -> tuple[list[Leaf], float]:
    """Leaves with their paths, and the expected value over the training rows."""
    by_place = {(n.tree, n.node): n for n in nodes}
    found, base = [], 0.0
    waiting: list[tuple[Node, dict]] = [(n, {}) for n in nodes if n.node == 0]
    while waiting:
        node, path = waiting.pop()
        if node.feature is None:
            features = tuple(path)
            leaf = Leaf(node.value, features, tuple(tuple(path[f][0]) for f in features), tuple(path[f][1] for f in features))
            found.append(leaf)
            base += node.value * float(np.prod(leaf.passing)) if features else node.value
            continue
        for child, left in ((node.left, True), (node.right, False)):
            below = by_place[node.tree, child]
            conditions, passing = path.get(node.feature, ([], 1.0))
            share = below.cover / node.cover if node.cover else 0.0
            waiting.append((below, path | {node.feature: ([*conditions, (node.threshold, node.categories, left)], passing * share)}))
    return found, base


def attributions(x: np.ndarray, paths: Sequence[Leaf]) -> np.ndarray:
    """Shares of every feature for every row of a matrix."""
    out = np.zeros(x.shape)
    for leaf in paths:
        if not leaf.features or leaf.value == 0.0:
            continue
        patterns, place = np.unique(leaf.through(x), return_inverse=True)
        out[:, leaf.features] += leaf.shares(patterns)[place]
    return out


def tree_shapley(nodes: Sequence[Node], rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """``id, feature, share, base`` of every row ``(id, x)``: shares plus base are the trees' raw value, exactly.

    Rows stay where they are; only the model's nodes are sent. A null or short ``x`` is left out.
    """
    paths, base = leaves(nodes)
    d, labels = len(names), list(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(part.num_rows, d)
                n = len(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(np.repeat(np.arange(n), d))), pa.array(labels * n, pa.string()),
                     pa.array(attributions(x, paths).ravel()), pa.array(np.full(n * d, base))],
                    ["id", "feature", "share", "base"],
                )

    kind = dict(rows.dtypes)["id"]
    known = rows.where(F.size("x") == d).select("id", F.col("x").cast("array<double>").alias("x"))
    return known.mapInArrow(run, f"id {kind}, feature string, share double, base double")
