"""Rows as blocks of numbers, so that many models take one product per block.

Columns that hold only zeros and ones in a block, as one-hot features do, take a bit a row.
Others take a byte if they have few values in the block, four if no digit is lost by that,
and eight otherwise. Copies of a row that follow each other are one row with how many of them
each fold holds out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 4096
# Packed rows are small, so what a task reads over and over may be more of them.
TASKS_TOGETHER = 4
BLOCK = "size INT, flags BINARY, bits BINARY, numbers ARRAY<BINARY>"
CODES = 256


def _counted(x: np.ndarray, label: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where rows begin that differ from the one before, and their copies per fold."""
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]).any(axis=1) | (label[1:] != label[:-1])
    row, folds = np.cumsum(new) - 1, int(fold.max()) + 1
    held = np.bincount(row * folds + fold, minlength=(row[-1] + 1) * folds)
    return np.flatnonzero(new), held.reshape(-1, folds)


def _written(column: np.ndarray) -> bytes:
    """Numbers in as few bytes as give them back, after a byte that tells how."""
    single = column.astype(np.float32)
    if len(column) > CODES:
        values = np.unique(column)
        if len(values) <= CODES:
            codes = np.searchsorted(values, column).astype(np.uint8)
            if (values[codes] == column).all():
                return bytes([len(values) - 1, 1]) + values.tobytes() + codes.tobytes()
    if (single == column).all():
        return b"\0\2" + single.tobytes()
    return b"\0\0" + column.tobytes()


def _read(data: bytes) -> np.ndarray:
    if data[1] == 1:
        values = np.frombuffer(data, count=data[0] + 1, offset=2)
        return values[np.frombuffer(data, np.uint8, offset=2 + values.nbytes)]
    return np.frombuffer(data, np.float32 if data[1] == 2 else np.float64, offset=2)


def feature_blocks(df: DataFrame) -> DataFrame:
    """The rows of ``df``, which has ``features, label, fold``, as blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = part.column(0).flatten().to_numpy().reshape(part.num_rows, -1)
                label = part.column(1).to_numpy()
                rows, held = _counted(x, label, part.column(2).to_numpy())
                x = x[rows]
                flags = ((x == 0) | (x == 1)).all(axis=0)
                numbers = np.column_stack([x[:, ~flags], label[rows], held])
                values = [
                    pa.array([len(rows)], pa.int32()),
                    pa.array([flags.tobytes()], pa.binary()),
                    pa.array([np.packbits(x[:, flags].T.astype(np.uint8), axis=1).tobytes()], pa.binary()),
                    pa.array([[_written(column) for column in numbers.T]], pa.list_(pa.binary())),
                ]
                yield pa.record_batch(values, names=[field.split()[0] for field in BLOCK.split(", ")])

    rows = df.select(
        vector_to_array("features"), F.col("label").cast("double"), F.col("fold").cast("int")
    )
    return rows.mapInArrow(run, BLOCK)


def gathered(blocks: DataFrame) -> DataFrame:
    """``blocks`` in fewer partitions, but as many as there are cores."""
    spark = blocks.sparkSession
    parts = blocks.rdd.getNumPartitions()
    return blocks.coalesce(max(spark.sparkContext.defaultParallelism, -(-parts // TASKS_TOGETHER)))


def opened(batches: Iterator[pa.RecordBatch], folds: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Of each block: which features are flags, these and the others as rows of a matrix,
    labels, and copies of the rows in each of the folds."""
    for batch in batches:
        for size, flags, bits, numbers in zip(*[c.to_pylist() for c in batch.columns]):
            flags = np.frombuffer(flags, bool)
            packed = np.frombuffer(bits, np.uint8).reshape(int(flags.sum()), -1)
            values = np.array([_read(column) for column in numbers], float)
            label = len(flags) - len(packed)
            held = np.zeros((max(folds, len(values) - label - 1), size), np.int64)
            held[: len(values) - label - 1] = values[label + 1 :]
            yield flags, np.unpackbits(packed, axis=1, count=size), values[:label], values[label], held


def unpacked(batches: Iterator[pa.RecordBatch], folds: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Features, labels and copies per fold of each block."""
    for flags, bits, numbers, label, held in opened(batches, folds):
        x = np.empty((len(label), len(flags)))
        x[:, flags], x[:, ~flags] = bits.T, numbers.T
        yield x, label, held


def products(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Each row times each of ``weights``, added up feature by feature: equal rows give
    equal sums wherever they stand in a block."""
    total = np.zeros((len(x), len(weights)))
    for column, own in zip(x.T, weights.T):
        total += column[:, None] * own
    return total


def block_scores(scored: Sequence):
    """Scores of the rows of blocks, for :func:`lendspark.operators.held_out.held_out_areas`.

    ``scored[fold]`` gives the scores of rows of features, a column per model.
    """

    def scores(batches: Iterator[pa.RecordBatch], step: int):
        for x, label, held in unpacked(batches, len(scored)):
            x, label, held = x[::step], label[::step], held[:, ::step]
            for fold, score in enumerate(scored):
                out = held[fold] > 0
                if out.any():
                    yield fold, score(x[out]), label[out], held[fold, out]

    return scores
