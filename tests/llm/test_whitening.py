"""Whitening against the same in plain numpy and Python integers."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendspark.llm import queries, whitening
from tests.conftest import SMALL

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>"


def brute(vectors):
    """Per id the deviation, and components as (explained, values per id)."""
    x = {k: np.array([int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v], object) for k, v in vectors.items()}
    fitted = np.array(sorted({tuple(v) for v in x.values()}), object)
    n, sums = len(fitted), fitted.sum(axis=0)
    centred = np.array((fitted * n - sums) / n, float)
    values, components = np.linalg.eigh(centred.T @ centred / n)
    values, components = values[::-1], components[:, ::-1]
    deviation = {k: int(((n * v - sums) ** 2).sum()) for k, v in x.items()}
    rows = {k: np.array((n * v - sums) / n, float) @ components for k, v in x.items()}
    return n, deviation, values, rows


def collected(df, **kwargs):
    found = {}
    for r in whitening.whiten(df, **kwargs).collect():
        found.setdefault(r["vec_id"], {})[r["component"]] = r
    return found


def compare(found, vectors):
    n, deviation, values, rows = brute(vectors)
    assert set(found) == set(vectors)
    count = min(16, len(values))
    signs = None
    for key, parts in found.items():
        assert sorted(parts) == list(range(1, count + 1))
        ours = np.array([parts[k]["whitened"] for k in range(1, count + 1)])
        theirs = rows[key][:count] / np.sqrt(values[:count])
        if signs is None:
            signs = np.where(ours * theirs < 0, -1, 1)
        assert np.allclose(ours, signs * theirs, atol=1e-7)
        first = parts[1]
        assert (first["n"], int(first["deviation"])) == (n, deviation[key])
        for k, r in parts.items():
            assert r["explained"] == pytest.approx(values[k - 1] / values.sum(), rel=1e-9)
            assert r["identity_error"] < 1e-9


def test_all_small_embeddings(spark):
    table = queries.table(spark, SMALL, "embeddings")
    vectors = {r["vec_id"]: r["embedding"] for r in table.collect()}
    found = {}
    for r in queries.QUERIES["op11_embedding_whitening"](spark, SMALL).collect():
        found.setdefault(r["vec_id"], {})[r["component"]] = r
    compare(found, vectors)


def test_few_dimensions_copies_and_unusable_rows(spark):
    random.seed(8)
    vectors = {i: [random.gauss(1000, 3), random.gauss(-5, 1), random.gauss(0, 9)] for i in range(60)}
    vectors |= {100 + i: vectors[0] for i in range(40)}
    unusable = [(200, None), (201, [1.0, None, 2.0]), (202, [1.0, float("nan"), 0.0]), (203, [float("-inf"), 0.0, 0.0]), (204, []), (205, [1.0])]
    df = spark.createDataFrame([*vectors.items(), *unusable], SCHEMA).withColumns({c: F.lit("c") for c in ("x", "dims", "n", "component")})
    compare(collected(df.repartition(3)), vectors)


def test_vectors_without_spread(spark):
    one = collected(spark.createDataFrame([(1, [2.0, 3.0]), (1, [2.0, 3.0]), (None, [2.0, 3.0])], SCHEMA))
    assert set(one) == {1, None}
    for parts in one.values():
        for r in parts.values():
            assert (r["n"], int(r["deviation"]), r["whitened"], r["explained"], r["identity_error"]) == (1, 0, None, None, None)
    line = collected(spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0]) for i in range(9)], SCHEMA))
    assert all(parts[2]["whitened"] is None and parts[3]["whitened"] is None for parts in line.values())
    assert line[0][1]["explained"] == pytest.approx(1.0) and line[0][1]["identity_error"] < 1e-9


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], SCHEMA)).count() == 0


def test_far_entries_do_not_overflow(spark):
    rows = [(i, [3e38 * (-1) ** i, float(i), 1e9 * i]) for i in range(6)]
    found = collected(spark.createDataFrame(rows, SCHEMA))
    clipped = [[min(max(int(np.floor(64 * float(np.float32(c)))), -whitening.BOUND), whitening.BOUND) for c in v] for _, v in rows]
    sums = [sum(column) for column in zip(*clipped)]
    for (key, _), x in zip(rows, clipped):
        assert int(found[key][1]["deviation"]) == sum((6 * a - s) ** 2 for a, s in zip(x, sums))
    assert found[0][1]["identity_error"] < 1e-4


def test_variances_of_sums_give_the_covariances(spark):
    random.seed(3)
    rows = [(i, [random.gauss(0, 5) for _ in range(4)]) for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    fitted, vectors = whitening.fit(df)
    whole = np.array([np.floor(64 * np.array(v, np.float32).astype(float)) for _, v in rows])
    expected = np.cov(whole.T, bias=True)
    rebuilt = fitted.vectors @ np.diag(fitted.values) @ fitted.vectors.T
    assert np.allclose(rebuilt, expected, rtol=1e-10)
    squares = whitening._squares(vectors, [0] * 4)
    assert squares[1] == int(((whole[:, 0] + whole[:, 1]) ** 2).sum())
