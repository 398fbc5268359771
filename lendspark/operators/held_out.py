"""Areas under the curves of many models at once, each over the rows of its fold.

Every task sorts the scores it finds under each model and cuts them into the same ranges.
With the scores of a range goes how many rows the task has above it, so whoever gathers a
range knows where its curve begins, and all ranges are worked out apart. Each distinct score
is a threshold, as in :mod:`lendspark.operators.evaluation`; where the cuts lie only decides
how evenly the work is dealt.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Gives ``(fold, scores, labels, copies)`` of every ``step``-th row of each block, a column
#: of scores per model.
Scores = Callable[[Iterator[pa.RecordBatch], int], Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]

RANGE_ROWS = 1 << 20
BUFFERED_ROWS = 1 << 17
TASK_SCORES = 1 << 22
SAMPLED_ROWS = 1 << 14
PIECES = (
    "fold INT, model INT, part INT, pos BINARY, pos_n BINARY, neg BINARY, neg_n BINARY,"
    " pos_above BIGINT, neg_above BIGINT"
)
PARTS = "fold INT, model INT, part INT, pos BIGINT, neg BIGINT, steps DOUBLE, pairs STRING"
Cuts = dict[int, np.ndarray]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"INT": pa.int32(), "BIGINT": pa.int64(), "BINARY": pa.binary(), "DOUBLE": pa.float64(), "STRING": pa.string()}
    fields = [field.split() for field in schema.split(",")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.record_batch(
        [pa.array(values, kinds[kind]) for values, (_, kind) in zip(columns, fields)],
        names=[name for name, _ in fields],
    )


def _runs(values: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted values; or, if many are equal, the distinct ones and their numbers."""
    if len(values):
        starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        if 3 * len(starts) < 2 * len(values):
            counts = np.diff(starts, append=len(values)).astype(np.int32)
            return values[starts].tobytes(), counts.tobytes()
    return values.tobytes(), b""


def _pieces(fold: int, gathered: list[tuple], cuts: Cuts) -> Iterator[tuple]:
    scores, label, copies = (np.concatenate(items) for items in zip(*gathered))
    sides = [(scores[rows], copies[rows]) for rows in (label == 1.0, label == 0.0)]
    for model in range(scores.shape[1]):
        own_cuts = cuts[fold][model] if fold in cuts else np.empty(0)
        edges, ordered = [], []
        for own, n in sides:
            ordered.append(np.sort(np.repeat(own[:, model], n)))
            inner = np.searchsorted(ordered[-1], own_cuts, side="right")
            edges.append(np.concatenate([[0], inner, [len(ordered[-1])]]))
        for part in range(len(own_cuts) + 1):
            values = [s for side, e in zip(ordered, edges) for s in _runs(side[e[part] : e[part + 1]])]
            yield (fold, model, part, *values, *[int(e[-1] - e[part + 1]) for e in edges])


def _pieces_of(scores: Scores, cuts: Cuts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: dict[int, list[tuple]] = {}
        size = 0
        for fold, *found in scores(batches, 1):
            gathered.setdefault(fold, []).append(tuple(found))
            size += len(found[1])
            if size >= BUFFERED_ROWS:
                for k, items in gathered.items():
                    yield _batch(list(_pieces(k, items, cuts)), PIECES)
                gathered, size = {}, 0
        for k, items in gathered.items():
            yield _batch(list(_pieces(k, items, cuts)), PIECES)

    return run


def _part(key: tuple, pieces: list[tuple]) -> tuple:
    """Rows of a range, its steps of the precision-recall curve, and twice its pairs of a
    positive row and a negative one below it, pairs of equal scores counting half."""
    values, numbers = [], [[], []]
    for piece in pieces:
        for side in (0, 1):
            value = np.frombuffer(piece[2 * side])
            n = np.frombuffer(piece[2 * side + 1], np.int32) if piece[2 * side + 1] else np.ones(len(value), np.int64)
            values.append(value)
            numbers[side].append(n)
            numbers[1 - side].append(np.zeros(len(value), np.int64))
    value = np.concatenate(values)
    if not len(value):
        return (*key, 0, 0, 0.0, "0")
    order = np.argsort(value)[::-1]
    value = value[order]
    starts = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    pos, neg = (np.add.reduceat(np.concatenate(n)[order].astype(np.int64), starts) for n in numbers)
    pos_above, neg_above = (sum(piece[k] for piece in pieces) for k in (4, 5))
    within = np.cumsum(pos)
    tp, fp = pos_above + within, neg_above + np.cumsum(neg)
    here = tp / (tp + fp)
    earlier = tp - pos + fp - neg
    before = np.where(earlier > 0, (tp - pos) / np.maximum(earlier, 1), here)
    pairs = 2 * pos_above * int(neg.sum()) + int((neg * (2 * within - pos)).sum())
    return (*key, int(pos.sum()), int(neg.sum()), float((pos * (here + before) / 2).sum()), str(pairs))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, pieces = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[:3] != key:
                if pieces:
                    yield _batch([_part(key, pieces)], PARTS)
                key, pieces = row[:3], []
            pieces.append(row[3:])
    if pieces:
        yield _batch([_part(key, pieces)], PARTS)


def _cuts(blocks: DataFrame, scores: Scores, folds: int, rows: int) -> Cuts:
    """Values that cut the scores of each model into ranges of about ``RANGE_ROWS``."""
    ranges = -(-rows // folds // RANGE_ROWS)
    if ranges < 2:
        return {}
    step = max(1, rows // SAMPLED_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fold, found, _, _ in scores(batches, step):
            yield _batch([(fold, found.shape[1], found.tobytes())], "fold INT, models INT, scores BINARY")

    sampled: dict[int, list] = {}
    for row in blocks.mapInArrow(run, "fold INT, models INT, scores BINARY").collect():
        sampled.setdefault(row["fold"], []).append(np.frombuffer(row["scores"]).reshape(-1, row["models"]))
    inner = np.arange(1, ranges) / ranges
    return {
        fold: np.quantile(np.concatenate(found), inner, axis=0, method="nearest").T
        for fold, found in sampled.items()
    }


def held_out_areas(
    blocks: DataFrame, scores: Scores, folds: int, models: int, rows: int, metric: str
) -> np.ndarray:
    """The area ``metric`` of each model in each fold, as a matrix.

    ``scores`` turns batches of ``blocks``, which stand for ``rows`` rows, into the scores of
    the rows that each fold holds out.
    """
    cuts = _cuts(blocks, scores, folds, rows)
    groups = folds * models * (1 + max((c.shape[1] for c in cuts.values()), default=0))
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    tasks = min(groups, max(cores, -(-rows * models // TASK_SCORES)))
    keys = ["fold", "model", "part"]
    parts = (
        blocks.mapInArrow(_pieces_of(scores, cuts), PIECES)
        .repartition(tasks, *keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(_parts, PARTS)
        .collect()  # one row per fold, model and range
    )
    found = np.zeros((folds, models))
    for fold in range(folds):
        for model in range(models):
            own = sorted(row for row in parts if (row["fold"], row["model"]) == (fold, model))
            pos, neg = (sum(row[side] for row in own) for side in ("pos", "neg"))
            if metric == "areaUnderPR" and pos:
                found[fold, model] = sum(row["steps"] for row in own) / pos
            elif metric == "areaUnderROC" and pos:
                pairs = sum(int(row["pairs"]) for row in own)
                found[fold, model] = pairs / 2 / pos / neg if neg else 1.0
    return found
