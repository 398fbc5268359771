"""Whitening of embeddings: components without correlation and of equal spread.

Method: polarisation covariance. Entries become integers, so their squares add up exactly
in any order. One aggregate over the distinct vectors gives the exact sum of squared
centred values of every dimension and of the sum of every two dimensions. As
``Var(a + b) = Var(a) + Var(b) + 2 Cov(a, b)``, differences of these variances are all
cross-covariances; put together they are the matrix whose eigenvectors are the components.

Values are centred before they are squared: about the integer next to the mean while
adding up, and exactly, with the rest ``S - n * centre``, when the sums are put together.
What meets on the driver are one number per pair of dimensions and the matrix, whose size
follows from the number of dimensions alone.

Defined cases: rows whose vector is NULL or holds a NULL, NaN or infinite entry are left
out, as are those that do not have the most frequent number of entries (of equally frequent
ones the larger), or none. An entry beyond ``BOUND`` in units of the scale counts as that
bound. Repeated vectors count once in the fit; each row gets its components, rows without
or with the same id too. A component without spread, as of a single vector, has NULL in
``whitened`` and counts for nothing in ``identity_error``, which is NULL if none is left;
``explained`` is NULL if nothing has any spread. No rows give no rows. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.llm.common import stored

# Largest size of an entry before the offset is added.
BOUND = 1 << 40
SAFE = 1 << 62
DIGITS = 10**38
ROWS = 1024


@dataclass(frozen=True)
class Whitening:
    """Settings: entries become ``floor(scale * entry) + offset``; ``components`` are kept."""

    scale: int = 64
    offset: int = 1_000_000
    components: int = 16


@dataclass(frozen=True)
class Fit:
    """What the distinct vectors say: their number, sums, and the components of theirs.

    ``vectors`` has a component per column, by falling eigenvalue; ``values`` are the
    eigenvalues and ``trace`` the sum of all of them.
    """

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float


def integers(df: DataFrame, settings: Whitening, vector: str, *keys: str) -> DataFrame:
    """``keys``, ``dims`` and ``x``, the integers as packed 64-bit numbers without offset.

    The offset changes neither distances nor covariances; it is added to the sums.
    """
    entry = F.col(vector)
    rows = df.select(*keys, entry.cast("array<double>").alias("entries")).where(
        entry.isNotNull()
        & F.forall(
            entry,
            lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")),
        )
        & (F.size(entry) > 0)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = batch.column(batch.num_columns - 1)
            sizes = entries.value_lengths().to_numpy()
            flat = entries.flatten().to_numpy()
            with np.errstate(over="ignore"):
                scaled = np.clip(np.floor(flat * settings.scale), -BOUND, BOUND).astype("<i8")
            cuts = np.concatenate([[0], np.cumsum(sizes)]) * 8
            data = pa.py_buffer(scaled.tobytes())
            packed = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(sizes), [None, pa.py_buffer(cuts.astype("<i8").tobytes()), data]
            )
            yield pa.record_batch(
                [*batch.columns[:-1], pa.array(sizes, pa.int32()), packed.cast(pa.binary())],
                names=[*keys, "dims", "x"],
            )

    kinds = dict(rows.dtypes)
    schema = "".join(f"`{key}` {kinds[key]}, " for key in keys) + "dims INT, x BINARY"
    return rows.mapInArrow(run, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    """A row of integers per packed vector; all are equally long."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), -1)


def _exact(values: np.ndarray, most: int) -> np.ndarray:
    """The same values, as Python's integers if sums of ``most`` would not fit in 64 bits."""
    return values.astype(object) if most >= SAFE else values


def _sums(vectors: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors, and the sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * dims, 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = _matrix(batch.column(0).slice(at, ROWS))
                rows = _exact(rows, int(np.abs(rows).max()) * len(rows))
                total = [a + int(b) for a, b in zip(total, rows.sum(axis=0))]
                n += len(rows)
        yield _numbers([-1, *range(dims)], [n, *total])

    found = _collected(vectors, run)
    return found.get(-1, 0), [found.get(k, 0) for k in range(dims)]


def _numbers(places: list[int], values: list[int]) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(places, pa.int64()), pa.array(map(Decimal, values), pa.decimal128(38, 0))],
        names=["place", "value"],
    )


def _collected(vectors: DataFrame, run) -> dict[int, int]:
    """The sum of the numbers of every place, from partial sums of the tasks."""
    partial = vectors.select("x").mapInArrow(run, "place BIGINT, value DECIMAL(38,0)")
    rows = partial.groupBy("place").agg(F.sum("value").alias("value")).collect()
    return {row["place"]: int(row["value"]) for row in rows}


def _squares(vectors: DataFrame, centre: list[int]) -> dict[int, int]:
    """Exact sums of squares about ``centre``: of dimension ``i`` at place ``i * dims + i``,
    of the sum of the dimensions ``i`` and ``j`` at ``i * dims + j``."""
    dims = len(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.triu_indices(dims, 1)
        total = {}
        about = np.array(centre, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = _matrix(batch.column(0).slice(at, ROWS)) - about
                rows = _exact(rows, 4 * int(np.abs(rows).max()) ** 2 * len(rows))
                for i in range(dims):
                    pairs = rows[:, i : i + 1] + rows[:, i + 1 :]
                    found = [(rows[:, i] ** 2).sum(), *(pairs**2).sum(axis=0)]
                    for j, value in enumerate(found, i):
                        place = i * dims + j
                        total[place] = total.get(place, 0) + int(value)
        if total:
            yield _numbers(list(total), list(total.values()))

    return _collected(vectors, run)


def fit(df: DataFrame, settings: Whitening = Whitening(), vector: str = "embedding") -> tuple[Fit | None, DataFrame]:
    """The components of the distinct vectors of ``df``, and those vectors; None without any."""
    every = integers(df, settings, vector)
    distinct = stored(every.groupBy("dims", "x").agg(F.count("*").alias("rows")), "vectors")
    lengths = distinct.groupBy("dims").agg(F.sum("rows").alias("rows"))
    usual = lengths.orderBy(F.desc("rows"), F.desc("dims")).first()
    if usual is None:
        return None, distinct
    dims = usual["dims"]
    vectors = distinct.where(F.col("dims") == dims)
    n, sums = _sums(vectors, dims)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre)]
    squares = _squares(vectors, centre)

    def spread(i: int, j: int) -> int:
        """n times the sum of squares about the mean."""
        about = rest[i] if i == j else rest[i] + rest[j]
        return n * squares[i * dims + j] - about * about

    alone = [spread(i, i) for i in range(dims)]
    covariance = np.empty((dims, dims))
    for i in range(dims):
        covariance[i, i] = Fraction(alone[i], n * n)
        for j in range(i + 1, dims):
            both = Fraction(spread(i, j) - alone[i] - alone[j], 2 * n * n)
            covariance[i, j] = covariance[j, i] = both
    values, components = np.linalg.eigh(covariance)
    fitted = Fit(n, sums, components[:, ::-1], values[::-1], float(Fraction(sum(alone), n * n)))
    return fitted, vectors


def _projection(fitted: Fit, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A matrix that whitens centred rows, and which of its components have any spread."""
    values = fitted.values[:most]
    floor = len(fitted.values) * np.finfo(float).eps * max(float(fitted.values[0]), 0.0)
    spread = values > floor
    scale = np.where(spread, 1 / np.sqrt(np.where(spread, values, 1.0)), 0.0)
    return fitted.vectors[:, :most] * scale, spread


def _centred(rows: np.ndarray, fitted: Fit) -> tuple[np.ndarray, np.ndarray]:
    """``n * x - S`` exactly, and ``x - S / n`` in double precision."""
    centre = np.array([s // fitted.n for s in fitted.sums], np.int64)
    rest = np.array([s % fitted.n for s in fitted.sums], np.int64)
    near = rows - centre
    scaled = _exact(near, 2 * fitted.n * (int(np.abs(near).max()) + 1)) * fitted.n - rest
    return scaled, near - rest / fitted.n


def identity_error(vectors: DataFrame, fitted: Fit, components: int) -> float | None:
    """The largest entry of the covariance of the whitened vectors, less the identity."""
    projection, spread = _projection(fitted, components)
    wide = int(spread.sum())
    if not wide:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, square = np.zeros(wide), np.zeros((wide, wide))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = _centred(_matrix(batch.column(0).slice(at, ROWS)), fitted)[1] @ projection[:, spread]
                total += rows.sum(axis=0)
                square += rows.T @ rows
        yield pa.record_batch(
            [pa.array(range(wide * (wide + 1)), pa.int32()), pa.array(np.concatenate([total, square.ravel()]))],
            names=["place", "value"],
        )

    partial = vectors.select("x").mapInArrow(run, "place INT, value DOUBLE")
    rows = partial.groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").collect()
    sums = np.array([row["value"] for row in rows]) / fitted.n
    mean, square = sums[:wide], sums[wide:].reshape(wide, wide)
    return float(np.abs(square - np.outer(mean, mean) - np.eye(wide)).max())


OUT = (
    "component INT, n BIGINT, deviation DECIMAL(38,0), whitened DOUBLE, explained DOUBLE,"
    " identity_error DOUBLE"
)


def whiten(
    df: DataFrame,
    settings: Whitening = Whitening(),
    vector: str = "embedding",
    vec_id: str = "vec_id",
) -> DataFrame:
    """One row per usable row of ``df`` and component:

    ``vec_id``; ``component`` from 1 on; ``n``, the vectors fitted on; ``deviation``, the
    exact sum of ``(n * x - S) ** 2``, NULL beyond 38 digits; ``whitened``, the row's place on the component in
    units of its deviation; ``explained``, the component's part of all variance; and
    ``identity_error``, how far the whitened vectors are from having the identity as
    covariance.
    """
    fitted, vectors = fit(df, settings, vector)
    kind = df.schema[vec_id].dataType.simpleString()
    schema = f"vec_id {kind}, {OUT}"
    if fitted is None:
        return df.sparkSession.createDataFrame([], schema)
    dims = len(fitted.sums)
    count = min(settings.components, dims)
    error = identity_error(vectors, fitted, count)
    projection, spread = _projection(fitted, count)
    explained = [float(v) / fitted.trace if fitted.trace else None for v in fitted.values[:count]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                scaled, centred = _centred(_matrix(part.column(2)), fitted)
                most = int(np.abs(scaled).max())
                squares = (_exact(scaled, most * most * dims) ** 2).sum(axis=1)
                if squares.dtype == object:
                    fits = [Decimal(int(x)) if x < DIGITS else None for x in squares]
                    deviation = pa.array(fits, pa.decimal128(38, 0))
                else:
                    deviation = pa.array(squares).cast(pa.decimal128(38, 0))
                rows = part.num_rows
                each = pa.array(np.repeat(np.arange(rows), count))
                whitened = centred @ projection
                unknown = np.tile(~spread, rows)
                yield pa.record_batch(
                    [
                        part.column(0).take(each),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * count, fitted.n)),
                        deviation.take(each),
                        pa.array(whitened.ravel(), mask=unknown),
                        pa.array(explained * rows, pa.float64()),
                        pa.array([error] * (rows * count), pa.float64()),
                    ],
                    names=["vec_id", *[field.split()[0] for field in OUT.split(", ")]],
                )

    usable = integers(df.withColumnRenamed(vec_id, "vec_id"), settings, vector, "vec_id")
    return usable.where(F.col("dims") == dims).mapInArrow(run, schema)
