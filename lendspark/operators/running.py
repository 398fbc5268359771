"""Running totals over a sorted table without gathering it in one place.

A window over a whole group puts the group into one task. Instead the rows are cut
into ranges of the sort key, which hold about the same number of rows each. The sums
per range are few, and from them follows the value that each range starts with; the
rest happens inside the ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE = "_range"


def key_ranges(
    df: DataFrame, order_by: Sequence[Column], path: str, groups: Sequence[str] = ()
) -> DataFrame:
    """``df`` with ``_range``, rising in sort order within each of ``groups``.

    Sort keys must be distinct within a group, or else one of them could fill a range;
    aggregate by them beforehand. The result is written to ``path``, in a folder that all
    executors share: all that follows has to see the same cuts, also after an executor is
    lost. The caller removes it.
    """
    keys = [F.col(name) for name in groups] + list(order_by)
    cut = df.repartitionByRange(*keys).withColumn(RANGE, F.spark_partition_id())
    cut.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def range_starts(ranges: DataFrame, totals: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """Per range, ``start_<column>`` and ``end_<column>`` of each running total.

    There are at most as many rows as partitions and groups together.
    """
    so_far = Window.partitionBy(*groups).orderBy(RANGE)
    sums = ranges.groupBy(*groups, RANGE).agg(*[F.sum(t).alias(f"_sum_{t}") for t in totals])
    ends = {f"end_{t}": F.sum(f"_sum_{t}").over(so_far) for t in totals}
    starts = {f"start_{t}": F.col(f"end_{t}") - F.col(f"_sum_{t}") for t in totals}
    return sums.withColumns(ends).withColumns(starts).drop(*[f"_sum_{t}" for t in totals])


def running_totals(
    ranges: DataFrame,
    totals: Sequence[str],
    order_by: Sequence[Column],
    groups: Sequence[str] = (),
) -> DataFrame:
    """Rows of :func:`key_ranges` with ``cum_<column>``: the sum up to and with the row."""
    starts = range_starts(ranges, totals, groups)
    within = Window.partitionBy(*groups, RANGE).orderBy(*order_by)
    sums = {
        f"cum_{t}": F.col(f"start_{t}") + F.sum(t).over(within) for t in totals
    }
    return (
        ranges.join(F.broadcast(starts), [*groups, RANGE])
        .withColumns(sums)
        .drop(RANGE, *[f"{side}_{t}" for side in ("start", "end") for t in totals])
    )
