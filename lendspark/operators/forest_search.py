"""Cross-validated search of random forests from few forests.

The first trees of a forest are a forest, and a tree cut at a depth is the tree grown to that
depth. So per fold and remaining setting one forest is grown, of the most trees and the
greatest depth, and its parts are scored for all smaller numbers and depths. All of them grow
together, see :mod:`lendspark.operators.growing`, if there are many rows; Spark fits each of
those of few rows, and of very deep ones. The draws of a forest that is fitted alone differ,
as those of another seed would.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.operators import growing
from lendspark.operators.blocks import block_scores, feature_blocks
from lendspark.operators.held_out import held_out_areas
from lendspark.session import work_folder

#: Settings that can be searched so.
KNOWN = {"numTrees", "maxDepth", "minInstancesPerNode"}
#: Rows that a fit by Spark takes little more than its jobs for.
FEW_ROWS = 1 << 17


class Tree:
    """The nodes of a fitted tree as arrays; a node that is no leaf can end a cut tree."""

    def __init__(self, rows: Sequence):
        rows = sorted(rows, key=lambda row: row["id"])
        stats = np.array([row["impurityStats"] for row in rows], float)
        self.share = stats[:, 1] / stats.sum(axis=1)
        self.vote = np.array([row["prediction"] for row in rows])
        self.left = np.array([row["leftChild"] for row in rows])
        self.right = np.array([row["rightChild"] for row in rows])
        self.feature = np.array([max(row["split"]["featureIndex"], 0) for row in rows])
        # Categories that go left, as a table; a threshold otherwise.
        widths = [row["split"]["numCategories"] for row in rows]
        self.by_table = np.array([width >= 0 for width in widths])
        self.table = np.zeros((len(rows), max(1, *widths, 1)), bool)
        self.threshold = np.zeros(len(rows))
        for k, row in enumerate(rows):
            values = row["split"]["leftCategoriesOrThreshold"]
            if self.left[k] >= 0 and widths[k] >= 0:
                self.table[k, np.array(values, int)] = True
            elif self.left[k] >= 0:
                self.threshold[k] = values[0]

    def cut(self, depth: int) -> np.ndarray:
        """Which nodes are leaves of the tree cut at ``depth``. Leaves side by side that
        vote alike are one, as in Spark's trees."""
        level = np.zeros(len(self.left), int)
        inner = np.flatnonzero(self.left >= 0)  # parents come before their children
        for k in inner:
            level[self.left[k]] = level[self.right[k]] = level[k] + 1
        leaf = (self.left < 0) | (level >= depth)
        for k in inner[::-1]:
            one, two = self.left[k], self.right[k]
            leaf[k] |= bool(leaf[one] and leaf[two] and self.vote[one] == self.vote[two])
        return leaf

    def shares(self, x: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """The share of the positive class where each row ends."""
        at, rows = np.zeros(len(x), int), np.arange(len(x))
        while True:
            rows = rows[~leaf[at[rows]]]
            if not len(rows):
                return self.share[at]
            node = at[rows]
            value = x[rows, self.feature[node]]
            category = np.clip(value, 0, self.table.shape[1] - 1).astype(int)
            goes_left = np.where(self.by_table[node], self.table[node, category], value <= self.threshold[node])
            at[rows] = np.where(goes_left, self.left[node], self.right[node])


def trees(spark: SparkSession, model: Model) -> list[Tree]:
    """The trees of a fitted forest, read from what it saves."""
    with work_folder(spark, "forest") as path:
        model.write().overwrite().save(path)
        # Nodes, whose number the settings bound.
        rows = spark.read.parquet(f"{path}/data").collect()
    found: dict[int, list] = {}
    for row in rows:
        found.setdefault(row["treeID"], []).append(row["nodeData"])
    return [Tree(found[k]) for k in sorted(found)]


def _scored(grown: dict[int, list[Tree]], settings: Sequence[tuple[int, int, int]]):
    """A function that scores rows of features under all forests of a fold.

    ``grown`` has the trees per least number of rows of a node.
    """
    cuts = {
        (depth, least): [tree.cut(depth) for tree in grown[least]]
        for _, depth, least in settings
    }

    def score(x: np.ndarray) -> np.ndarray:
        found = np.zeros((len(x), len(settings)))
        for (depth, least), leaves in cuts.items():
            wanted = {count: k for k, (count, d, n) in enumerate(settings) if (d, n) == (depth, least)}
            total = np.zeros(len(x))
            for at, (tree, leaf) in enumerate(zip(grown[least], leaves), 1):
                total += tree.shares(x, leaf)
                if at in wanted:
                    found[:, wanted[at]] = total
        return found

    return score


def fold_metrics(
    df: DataFrame, folds: int, settings: Sequence[tuple[int, int, int]], metric: str, estimator: Estimator
) -> np.ndarray | None:
    """The metric of each setting ``(numTrees, maxDepth, minInstancesPerNode)`` in each fold.

    ``df`` has ``features``, ``label`` and ``fold``. None if a part has not both classes.
    """
    counts = {
        (row["fold"], row["label"]): row["count"] for row in df.groupBy("fold", "label").count().collect()
    }
    if set(counts) != {(fold, label) for fold in range(folds) for label in (0.0, 1.0)}:
        return None
    rows = sum(counts.values())
    bounded = max(depth for _, depth, _ in settings) <= growing.DEEPEST and estimator.getMaxBins() <= growing.MOST_BINS
    if rows > FEW_ROWS and bounded:
        return growing.fold_metrics(df, folds, settings, metric, estimator, rows)
    scored = fitted(df, folds, settings, estimator)
    return held_out_areas(feature_blocks(df), block_scores(scored), folds, len(settings), rows, metric)


def fitted(df: DataFrame, folds: int, settings: Sequence[tuple[int, int, int]], estimator: Estimator) -> list:
    """Per fold a function that scores rows under the forests that Spark fits to the others."""
    most, deepest = (max(setting[k] for setting in settings) for k in (0, 1))
    scored = []
    for fold in range(folds):
        part = df.where(F.col("fold") != fold)
        grown = {}
        for least in sorted({setting[2] for setting in settings}):
            own = estimator.copy().setNumTrees(most).setMaxDepth(deepest).setMinInstancesPerNode(least)
            grown[least] = trees(df.sparkSession, own.fit(part))
        scored.append(_scored(grown, settings))
    return scored
