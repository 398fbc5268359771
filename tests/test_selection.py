"""Percentiles by narrowing: any order, heavy values, NaN, and few rows moved."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lendspark.operators import profile, selection

FRACTIONS = {"p01": "0.01", "p25": "0.25", "median": "0.50", "p75": "0.75", "p95": "0.95", "p100": "1"}


def summary(df):
    return {r["feature"]: r for r in profile.numeric_summary(df, df.columns, FRACTIONS).collect()}


def expected(values, fraction):
    rank = max(1, math.ceil(round(float(fraction) * len(values), 6)))
    return sorted(values, key=lambda v: (math.isnan(v), v))[rank - 1]


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(selection, "FEW", 50)
    monkeypatch.setattr(selection, "SKETCH_SIZE", 64)
    monkeypatch.setattr(selection, "SLACK", 0.02)


def test_narrowing_in_any_order(spark, few):
    random.seed(11)
    n = 6000
    columns = {
        "even": [float(i) for i in range(n)],
        "heavy": [3.0] * (n // 2) + [random.uniform(0, 6) for _ in range(n // 2)],
        "one": [7.0] * n,
        "odd": [math.nan] * (n // 10) + [float("-inf")] * 5 + [None] * 100 + [random.gauss(0, 1) for _ in range(n - n // 10 - 105)],
    }
    schema = ", ".join(f"{name} DOUBLE" for name in columns)
    ascending = spark.createDataFrame(list(zip(*columns.values())), schema).coalesce(4)
    for df in (ascending, ascending.repartition(7), ascending.orderBy(F.desc("even"))):
        found = summary(df)
        for name, values in columns.items():
            known = [v for v in values if v is not None]
            for p, fraction in FRACTIONS.items():
                wanted = expected(known, fraction)
                assert found[name][p] == wanted or math.isnan(wanted) and math.isnan(found[name][p]), (name, p)


def test_sorted_rows_are_narrowed_as_much_as_shuffled_ones(spark, monkeypatch):
    """What is left to sort does not depend on the order of the rows."""
    left = []
    sorted_rows = selection._sorted
    monkeypatch.setattr(selection, "FEW", 20_000)
    monkeypatch.setattr(selection, "_sorted", lambda n, s: (left.append(sum(x.inside for x in s)), sorted_rows(n, s)))
    ordered = spark.range(0, 400_000, 1, 8).select(F.col("id").cast("double").alias("x"))
    shuffled = ordered.orderBy(F.xxhash64("x")).persist()
    results = [summary(df)["x"] for df in (ordered, shuffled)]
    shuffled.unpersist()
    exact = [[r[p] for p in (*FRACTIONS, "min_value", "max_value", "non_null_count")] for r in results]
    assert exact[0] == exact[1] and results[0]["median"] == 199_999.0
    # Six percentiles, each of whose intervals holds about a hundredth of the rows at most.
    assert max(left) < 6 * 400_000 * 0.012


def test_counts_decide_and_not_the_sketch():
    """A bracket that misses still narrows, on either side."""
    values = list(range(100))
    counts = lambda low, high: [sum(v < low for v in values), sum(v <= low for v in values), sum(v < high for v in values), sum(v <= high for v in values)]
    for rank in range(1, 101):
        search = selection.Search("c", rank, 100)
        brackets = [(40.0, 60.0), (10.0, 20.0), (90.0, 95.0), (50.0, 50.0)]
        for low, high in brackets:
            inside = (search.low is None or search.low < low) and (search.high is None or high < search.high)
            if not search.found and inside:
                search.narrow(low, high, counts(low, high))
        if search.found:
            assert search.value == rank - 1
        else:
            between = [v for v in values if (search.low is None or v > search.low) and (search.high is None or v < search.high)]
            assert len(between) == search.inside and between[search.rank - 1] == rank - 1


def test_moments_of_parts():
    mean, deviation = selection.combined_moments([(2, 1.0, 1.0), (0, None, None), (2, 5.0, 1.0)])
    assert (mean, deviation) == (3.0, math.sqrt(5.0))
    assert selection.combined_moments([]) == (None, None)
