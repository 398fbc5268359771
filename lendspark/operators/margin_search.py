"""Cross-validated search of linear support vector machines, all combinations at once.

Every fit of the search looks for the least mean hinge loss of its training part plus its
penalty, over standardised features. One pass over the rows gives the loss and its slope for
the present point of all fits together, so the number of passes is that of the slowest fit
and does not depend on the grid. Steps are those of L-BFGS; a fit ends when its values of the
last steps agree to ``tol`` of the first one, or after ``limit`` steps. Fits that differ in their
``tol`` alone take the same steps, so they are one search that some leave earlier. The loss has kinks, so
fits end before the very minimum, and averages of other optimisers differ a little; Spark's
own ends higher. The depth of Spark's aggregation changes no model.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.operators.blocks import block_scores, feature_blocks, gathered, opened, products
from lendspark.operators.held_out import held_out_areas

#: Settings whose effect is known here.
KNOWN = {"regParam", "tol", "aggregationDepth"}
MEMORY, RECENT, TRIALS = 10, 20, 20


@dataclass(frozen=True)
class Part:
    """Rows, means and inverse deviations (0 for a constant) of the training part of a fold."""

    count: int
    mean: np.ndarray
    scale: np.ndarray

    def plain(self, point: np.ndarray) -> np.ndarray:
        """Weights and intercept for features as they are."""
        weights = point[:-1] * self.scale
        return np.append(weights, point[-1] - weights @ self.mean)

    def slope(self, sums: np.ndarray) -> np.ndarray:
        """The slope at standardised weights, from sums over features as they are."""
        return np.append((sums[:-1] - sums[-1] * self.mean) * self.scale, sums[-1]) / self.count


def training_parts(df: DataFrame, folds: int) -> list[Part] | None:
    """The training part of each fold, from one pass; None if one has not both classes."""
    summary = Summarizer.metrics("count", "mean", "variance").summary(F.col("features"))
    rows = df.groupBy("fold", "label").agg(summary.alias("s")).collect()
    parts = []
    for fold in range(folds):
        own = [row for row in rows if row["fold"] != fold]
        if {row["label"] for row in own} != {0.0, 1.0}:
            return None
        counts = np.array([row["s"]["count"] for row in own], float)[:, None]
        means = np.array([row["s"]["mean"].toArray() for row in own])
        spread = np.array([row["s"]["variance"].toArray() for row in own]) * (counts - 1)
        count = counts.sum()
        mean = (counts * means).sum(axis=0) / count
        deviation = np.sqrt((spread + counts * (means - mean) ** 2).sum(axis=0) / max(count - 1, 1))
        scale = np.divide(1.0, deviation, out=np.zeros_like(deviation), where=deviation > 0)
        parts.append(Part(int(count), mean, scale))
    return parts


def hinge_sums(blocks: DataFrame, models: np.ndarray, folds: np.ndarray) -> np.ndarray:
    """Per model the sums of slope, of its intercept's part, and of loss, over all rows that
    are not in its fold."""
    weights, intercepts = models[:, :-1], models[:, -1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(models), models.shape[1] + 1))
        for flags, bits, numbers, label, held in opened(batches, int(folds.max()) + 1):
            kinds = [(np.flatnonzero(flags), bits.astype(float)), (np.flatnonzero(~flags), numbers)]
            margin = sum(weights[:, own] @ x for own, x in kinds) + intercepts[:, None]
            sign = 2 * label - 1
            slack = np.maximum(1 - sign * margin, 0.0)
            taken = held.sum(axis=0) - held[folds]
            pull = np.where(slack > 0, -sign * taken, 0.0)
            for own, x in kinds:
                total[:, own] += pull @ x.T
            total[:, -2] += pull.sum(axis=1)
            total[:, -1] += (taken * slack).sum(axis=1)
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    sums = blocks.mapInArrow(run, "sums BINARY").collect()  # one row per task
    return sum(np.frombuffer(row["sums"]).reshape(len(models), -1) for row in sums)


def _direction(slope: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    down, kept = -slope, []
    for moved, turned in reversed(steps):
        share = (moved @ down) / (moved @ turned)
        down = down - share * turned
        kept.append(share)
    if steps:
        moved, turned = steps[-1]
        down = down * (moved @ turned) / (turned @ turned)
    for (moved, turned), share in zip(steps, reversed(kept)):
        down = down + (share - (turned @ down) / (moved @ turned)) * moved
    return down


def least(start: np.ndarray, tols: Sequence[float], limit: int) -> Generator:
    """Yields points, is sent ``(value, slope)`` of each, and returns where it ends for each
    of ``tols``."""
    point = start
    value, slope = yield point
    first, recent, steps = value, [value], []
    ends: dict[float, np.ndarray] = {}
    for _ in range(limit):
        down = _direction(slope, steps)
        if slope @ down >= 0:
            steps, down = [], -slope
        falls = slope @ down
        if falls > -1e-16:
            break
        size, low, high = 1.0 if steps else 0.5 / np.linalg.norm(slope), 0.0, np.inf
        for _ in range(TRIALS):
            trial = point + size * down
            there, its_slope = yield trial
            if there > value + 1e-4 * size * falls:
                high = size
            elif its_slope @ down < 0.9 * falls:
                low = size
            else:
                break
            size = 2 * size if high == np.inf else (low + high) / 2
        if there >= value:
            break
        moved, turned = trial - point, its_slope - slope
        if moved @ turned > 1e-12 * (turned @ turned):
            steps = [*steps, (moved, turned)][-MEMORY:]
        point, value, slope = trial, there, its_slope
        recent = [*recent, value][-RECENT:]
        for tol in tols:
            if abs(max(recent) - value) <= tol * first:
                ends.setdefault(tol, point)
        if all(tol in ends for tol in tols):
            break
    return [ends.get(tol, point) for tol in tols]


def fitted(
    blocks: DataFrame, parts: Sequence[Part], settings: Sequence[tuple[float, float]], limit: int
) -> np.ndarray:
    """Weights and intercept per fold and setting ``(penalty, tol)``."""
    width = len(parts[0].mean) + 1
    tols: dict[float, list[float]] = {}
    for penalty, tol in settings:
        tols.setdefault(penalty, []).append(tol)
    searches = {
        (fold, penalty): least(np.zeros(width), own, limit)
        for fold in range(len(parts))
        for penalty, own in tols.items()
    }
    points = {key: next(search) for key, search in searches.items()}
    ends: dict[tuple[int, float, float], np.ndarray] = {}
    while points:
        folds = np.array([fold for fold, _ in points])
        plain = np.array([parts[fold].plain(point) for (fold, _), point in points.items()])
        for key, sums in zip(list(points), hinge_sums(blocks, plain, folds)):
            fold, penalty = key
            weights = np.append(points[key][:-1], 0.0)
            value = sums[-1] / parts[fold].count + penalty / 2 * (weights @ weights)
            try:
                points[key] = searches[key].send((value, parts[fold].slope(sums[:-1]) + penalty * weights))
            except StopIteration as end:
                for tol, point in zip(tols[penalty], end.value):
                    ends[(fold, penalty, tol)] = parts[fold].plain(point)
                del points[key]
    return np.array([[ends[(fold, *setting)] for setting in settings] for fold in range(len(parts))])


def fold_metrics(
    df: DataFrame, folds: int, settings: Sequence[tuple[float, float]], metric: str, limit: int
) -> np.ndarray | None:
    """The metric of each setting ``(penalty, tol)`` in each fold, as a matrix.

    ``df`` has ``features``, ``label`` and ``fold``. None if a training part has not both
    classes.
    """
    parts = training_parts(df, folds)
    if parts is None:
        return None
    blocks = gathered(feature_blocks(df)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        models = fitted(blocks, parts, settings, limit)
        scored = [lambda x, own=own: products(x, own[:, :-1]) + own[:, -1] for own in models]
        rows = sum(part.count for part in parts) // max(folds - 1, 1)  # each is in all parts but one
        return held_out_areas(blocks, block_scores(scored), folds, len(settings), rows, metric)
    finally:
        blocks.unpersist()
