"""Cross-validated search of naive Bayes from statistics that all combinations share.

The scaler and the classifier of every combination follow from sums, ranges and counts of
the features per class. These are added up once per fold and class; those of a training part
are sums over the other folds, and scaled sums follow as scaling is linear. One more pass
scores each held-out row with every model of its fold, and the curves of all models are
worked out together. So the number of jobs does not depend on the grid.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.operators.blocks import block_scores, feature_blocks
from lendspark.operators.held_out import held_out_areas

#: Settings whose effect is known here; thresholds change no score.
KNOWN = {"scaler.max", "smoothing", "thresholds"}


@dataclass(frozen=True)
class ClassSums:
    """Rows of a class, and per feature their sum, least and largest value."""

    count: int
    sums: np.ndarray
    least: np.ndarray
    most: np.ndarray

    def __add__(self, other: ClassSums) -> ClassSums:
        return ClassSums(
            self.count + other.count,
            self.sums + other.sums,
            np.minimum(self.least, other.least),
            np.maximum(self.most, other.most),
        )


def random_folds(df: DataFrame, folds: int, seed: int) -> DataFrame:
    """``df`` with the ``fold`` that Spark's own cross validation puts a row in.

    As there, rows have to come from a frame that is kept, or their numbers may change.
    """
    drawn = df.withColumn("_drawn", F.rand(seed))
    fold = sum((F.col("_drawn") >= k * (1.0 / folds)).cast("int") for k in range(1, folds))
    return drawn.withColumn("fold", fold).drop("_drawn")


def class_sums(df: DataFrame) -> dict[tuple[int, float], ClassSums]:
    """Sums per fold and label, from one pass."""
    summary = Summarizer.metrics("count", "sum", "min", "max").summary(F.col("features"))
    rows = df.groupBy("fold", "label").agg(summary.alias("s")).collect()
    return {
        (row["fold"], row["label"]): ClassSums(
            row["s"]["count"], *[row["s"][name].toArray() for name in ("sum", "min", "max")]
        )
        for row in rows
    }


@dataclass(frozen=True)
class Scaling:
    """Features to ``[0, 1]`` as they were in a training part; constant ones to a half."""

    least: np.ndarray
    width: np.ndarray

    def scaled_sums(self, part: ClassSums) -> np.ndarray:
        spread = np.where(self.width > 0, self.width, 1.0)
        return np.where(self.width > 0, (part.sums - part.count * self.least) / spread, part.count / 2)


def _weights(scaled: np.ndarray, count: int, total: int, labels: int, largest: float, smoothing: float):
    """Log weights of the features and the log prior of a class."""
    sums = scaled * largest
    weights = np.log(sums + smoothing) - np.log(sums.sum() + len(sums) * smoothing)
    return weights, float(np.log(count + smoothing) - np.log(total + labels * smoothing))


def fold_models(sums: dict, fold: int, settings: Sequence[tuple[float, float]]):
    """Scaling, and per setting the weights and prior of the positive class, of one fold.

    None if the training part has not both classes.
    """
    parts: dict[float, ClassSums] = {}
    for (other, label), part in sums.items():
        if other != fold:
            parts[label] = parts[label] + part if label in parts else part
    if set(parts) != {0.0, 1.0}:
        return None
    whole = parts[0.0] + parts[1.0]
    scaling = Scaling(whole.least, whole.most - whole.least)
    positive = parts[1.0]
    scaled = scaling.scaled_sums(positive)
    return scaling, [
        (largest, *_weights(scaled, positive.count, whole.count, len(parts), largest, smoothing))
        for largest, smoothing in settings
    ]


def _scored(scaling: Scaling, models: Sequence[tuple]):
    """A function that scores rows of features under all models of a fold."""
    weights = np.array([own for _, own, _ in models])
    largest = np.array([most for most, _, _ in models])
    priors = np.array([prior for _, _, prior in models])
    spread = np.where(scaling.width > 0, scaling.width, 1.0)

    def score(x: np.ndarray) -> np.ndarray:
        unit = np.where(scaling.width > 0, np.maximum((x - scaling.least) / spread, 0.0), 0.5)
        total = np.zeros((len(x), len(models)))
        for column, own in zip(unit.T, weights.T):
            total += column[:, None] * largest * own
        return total + priors

    return score


def fold_metrics(df: DataFrame, folds: int, settings: Sequence[tuple[float, float]], metric: str) -> np.ndarray | None:
    """The metric of each setting ``(largest, smoothing)`` in each fold, as a matrix.

    ``df`` has ``features``, ``label`` and ``fold``, and is read twice. None if a training
    part has not both classes.
    """
    sums = class_sums(df)
    fitted = [fold_models(sums, fold, settings) for fold in range(folds)]
    if None in fitted:
        return None
    blocks = feature_blocks(df)
    scored = [_scored(scaling, models) for scaling, models in fitted]
    rows = sum(part.count for part in sums.values())
    return held_out_areas(blocks, block_scores(scored), folds, len(settings), rows, metric)
