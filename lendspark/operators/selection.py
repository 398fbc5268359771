"""Exact percentiles of many columns at once, in whatever order the rows come.

Distributed selection: a sketch of all values, merged in two steps, names two values around
each percentile. Exact counts say how many rows lie below, at, between and above the two, and
so which of them is the percentile, or in which open interval it lies and at what rank. That
narrows an interval to a small part of its rows each time, and repeats until it holds few
enough to be sorted. Only counts decide, so an unlucky sketch costs a round and never a
result, and a value that fills half of the column is found as a value, not as a range.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Sketches are merged in this many places before they are merged in one.
MERGE_GROUPS = 64
# Size of a sketch; its ranks are off by about a thousandth of the rows at most.
SKETCH_SIZE = 4096
SLACK = 0.002
# An interval of so many rows is grouped and sorted.
FEW = 200_000


@dataclass
class Search:
    """The value of rank ``rank`` among the rows of ``column`` between ``low`` and ``high``.

    Both are excluded, and None for no bound; ``inside`` rows lie between them and
    ``before`` at ``low`` or under it.
    """

    column: str
    rank: int
    inside: int
    low: float | None = None
    high: float | None = None
    before: int = 0
    value: float | None = None
    found: bool = False

    def holds(self) -> Column:
        value = F.col(self.column)
        holds = value.isNotNull() & ~F.isnan(value)
        if self.low is not None:
            holds = holds & (value > self.low)
        if self.high is not None:
            holds = holds & (value < self.high)
        return holds

    def settle(self, value: float) -> None:
        self.value, self.found = value, True

    def narrow(self, low: float, high: float, counts: Sequence[int]) -> None:
        """Take note of the rows under ``low``, up to it, under ``high``, and up to it."""
        under, upto, under_high, upto_high = [n - self.before for n in counts]
        if self.rank <= under:
            self.high, self.inside = low, under
        elif self.rank <= upto:
            self.settle(low)
        elif self.rank <= under_high:
            self.low, self.high, self.inside = low, high, under_high - upto
            self.rank, self.before = self.rank - upto, self.before + upto
        elif self.rank <= upto_high:
            self.settle(high)
        else:
            self.low, self.inside = high, self.inside - upto_high
            self.rank, self.before = self.rank - upto_high, self.before + upto_high


def merge_group() -> Column:
    return F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))


def sketch(value: Column) -> Column:
    return F.kll_sketch_agg_double(value, F.lit(SKETCH_SIZE))


def quantiles(merged: Column, ranks: Sequence[float]) -> Column:
    inside = [min(1.0, max(0.0, rank)) for rank in ranks]
    return F.when(
        F.kll_sketch_get_n_double(merged) > 0,
        F.kll_sketch_get_quantile_double(merged, F.array(*map(F.lit, inside))),
    )


def around(fraction: float) -> tuple[float, float]:
    return fraction - SLACK, fraction + SLACK


def _brackets(numbers: DataFrame, searches: Sequence[Search]) -> list[tuple[float, float]]:
    """Two values around each of the searches, from sketches of what lies in its interval."""
    names = [f"s{k}" for k in range(len(searches))]
    parts = numbers.groupBy(merge_group().alias("_group")).agg(
        *[sketch(F.when(s.holds(), F.col(s.column))).alias(n) for s, n in zip(searches, names)]
    )
    merged = parts.agg(*[F.kll_merge_agg_double(n).alias(n) for n in names])
    row = merged.select(
        *[quantiles(F.col(n), around(s.rank / s.inside)).alias(n) for s, n in zip(searches, names)]
    ).first()
    return [tuple(row[n]) for n in names]


def narrow(numbers: DataFrame, searches: Sequence[Search], brackets: Sequence[tuple[float, float]]) -> None:
    """One pass of exact counts about the two values of each search."""
    value = lambda s: F.when(~F.isnan(s.column), F.col(s.column))
    counts = [
        F.count_if(condition)
        for s, (low, high) in zip(searches, brackets)
        for condition in (value(s) < low, value(s) <= low, value(s) < high, value(s) <= high)
    ]
    row = list(numbers.agg(*[c.alias(f"n{k}") for k, c in enumerate(counts)]).first())
    for k, (search, (low, high)) in enumerate(zip(searches, brackets)):
        search.narrow(low, high, row[4 * k : 4 * k + 4])


def _sorted(numbers: DataFrame, searches: Sequence[Search]) -> None:
    """The rest: values in the intervals, which are few, counted and put in order."""
    entries = [
        F.when(s.holds(), F.struct(F.lit(k).alias("search"), F.col(s.column).alias("value")))
        for k, s in enumerate(searches)
    ]
    ranks = F.create_map(*[F.lit(x) for k, s in enumerate(searches) for x in (k, s.rank)])
    upwards = Window.partitionBy("search").orderBy("value")
    rows = (
        numbers.select(F.inline(F.array_compact(F.array(*entries))))
        .groupBy("search", "value")
        .agg(F.count("*").alias("n"))
        .withColumn("reached", F.sum("n").over(upwards))
        .where(F.col("reached") >= ranks[F.col("search")])
        .groupBy("search")
        .agg(F.min("value").alias("value"))
        .collect()
    )
    for row in rows:
        searches[row["search"]].settle(row["value"])


def select(numbers: DataFrame, searches: Sequence[Search]) -> None:
    """Settle all searches that are still open."""
    while True:
        open_ones = [s for s in searches if not s.found]
        wide = [s for s in open_ones if s.inside > FEW]
        if not wide:
            break
        narrow(numbers, wide, _brackets(numbers, wide))
    if open_ones:
        _sorted(numbers, open_ones)


def combined_moments(parts: Sequence[tuple[int, float, float]]) -> tuple[float | None, float | None]:
    """Mean and population deviation of a whole from count, mean and variance of its parts."""
    parts = sorted((n, mean, variance) for n, mean, variance in parts if n)
    total = sum(n for n, _, _ in parts)
    if not total:
        return None, None
    mean = math.fsum(n * m for n, m, _ in parts) / total
    if not math.isfinite(mean):
        mean = sum(m * (n / total) for n, m, _ in parts)
    if not math.isfinite(mean):
        return mean, math.nan
    variance = math.fsum(n * (v + (m - mean) ** 2) for n, m, v in parts) / total
    return mean, math.sqrt(variance)


def percentile_searches(column: str, real: int, unreal: int, fractions: Mapping[str, int]) -> dict[str, Search]:
    """A search per name for the rank given; ranks beyond the ``real`` values are NaN."""
    searches = {}
    for name, rank in fractions.items():
        search = Search(column, rank, real)
        if rank > real or not real + unreal:
            search.settle(math.nan if unreal else None)
        searches[name] = search
    return searches
