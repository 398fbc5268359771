"""Column profiles of any table.

Each reads the table once, but for :func:`numeric_summary`, which looks again for exact
percentiles.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.constants import PERCENTILES, Buckets
from lendspark.functions.buckets import bucket
from lendspark.functions.measures import percent, row_count
from lendspark.operators import selection


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column: count, rows, and percentage."""
    counts = df.agg(
        row_count().alias("total_rows"),
        *[F.count_if(F.col(name).isNull()).alias(name) for name in columns],
    )
    return counts.unpivot(["total_rows"], list(columns), "column_name", "null_count").select(
        "column_name",
        "null_count",
        "total_rows",
        percent(F.col("null_count"), F.col("total_rows"), 4).alias("null_pct"),
    )


def with_share(counts: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Counts with ``share_pct``, their percentage of the group's (or grand) total.

    The totals are one row per group and are broadcast back, so a group with very
    many values is never sorted in one task. Both sides read the same shuffle.
    """
    totals = counts.groupBy(*groups).agg(F.sum("count").alias("_total"))
    joined = (
        counts.join(F.broadcast(totals), list(groups))
        if groups
        else counts.crossJoin(F.broadcast(totals))
    )
    return joined.withColumn("share_pct", percent(F.col("count"), F.col("_total"), 4)).drop(
        "_total"
    )


def status_distribution(df: DataFrame, column: str = "loan_status") -> DataFrame:
    """Rows and share per value of one column, unknown values shown as ``NULL``."""
    value = F.coalesce(F.col(column), F.lit("NULL")).alias(column)
    return with_share(df.groupBy(value).agg(row_count().alias("count")))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and share of every value of every column, in long form."""
    texts = df.select(*[F.col(name).cast("string").alias(name) for name in columns])
    counts = (
        texts.unpivot([], list(columns), "feature", "value")
        .groupBy("feature", F.coalesce("value", F.lit("NULL")).alias("value"))
        .agg(row_count().alias("count"))
    )
    return with_share(counts, ["feature"])


def distribution(df: DataFrame, buckets: Mapping[str, Buckets]) -> DataFrame:
    """Rows and share per bucket of every column, in long form."""
    labels = df.select(*[bucket(F.col(name), b).alias(name) for name, b in buckets.items()])
    counts = (
        labels.unpivot([], list(buckets), "feature", "bucket")
        .groupBy("feature", "bucket")
        .agg(row_count().alias("count"))
    )
    return with_share(counts, ["feature"])


def numeric_summary(
    df: DataFrame,
    columns: Sequence[str],
    percentiles: Mapping[str, str] = PERCENTILES,
) -> DataFrame:
    """Counts, range, exact percentiles, mean and population deviation per column.

    ``percentiles`` maps output names to fractions written as decimal text. The
    value taken is the first one whose rank reaches ``ceil(fraction * count)``.

    One pass gives everything that can be merged, and a sketch of each column; a second
    one counts about the percentiles that the sketch suggests, and a third sorts the few
    values between. Very large tables take two more passes for each narrowing, see
    :mod:`lendspark.operators.selection`. The passes run when this is called.
    """
    numbers = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    fractions = {name: Decimal(text) for name, text in percentiles.items()}
    suggested = [rank for f in fractions.values() for rank in selection.around(float(f))]

    def partial(name: str) -> Column:
        value = F.col(name)
        real = F.when(~F.isnan(value), value)
        return F.struct(
            row_count().alias("rows"),
            F.count(value).alias("n"),
            F.count(real).alias("real"),
            F.min(value).alias("least"),
            F.max(value).alias("most"),
            F.struct(F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_pop(value).alias("variance")).alias("moments"),
            selection.sketch(real).alias("sketch"),
        ).alias(name)

    grouped = numbers.groupBy(selection.merge_group().alias("_group")).agg(*[partial(c) for c in numbers.columns])
    parts = grouped.select(F.posexplode(F.array(*numbers.columns)).alias("position", "part"))
    whole = parts.groupBy("position").agg(
        *[F.sum(f"part.{name}").alias(name) for name in ("rows", "n", "real")],
        F.min("part.least").alias("least"),
        F.max("part.most").alias("most"),
        F.collect_list("part.moments").alias("moments"),
        F.kll_merge_agg_double("part.sketch").alias("sketch"),
    )
    whole = whole.withColumn("suggested", selection.quantiles(F.col("sketch"), suggested)).drop("sketch")
    basics = {row["position"]: row for row in whole.collect()}

    searches = {
        k: selection.percentile_searches(
            f"c{k}",
            row["real"],
            row["n"] - row["real"],
            {name: math.ceil(f * row["n"]) for name, f in fractions.items()},
        )
        for k, row in basics.items()
    }
    looked = [
        (search, tuple(basics[k]["suggested"][2 * p : 2 * p + 2]))
        for k, of_column in searches.items()
        for p, search in enumerate(of_column.values())
        if not search.found and search.inside > selection.FEW
    ]
    if looked:
        selection.narrow(numbers, *zip(*looked))
    selection.select(numbers, [search for of_column in searches.values() for search in of_column.values()])

    def summary(k: int, feature: str) -> tuple:
        row = basics.get(k)
        if row is None:
            return feature, 0, 0, None, *[None] * len(fractions), None, None, None
        mean, deviation = selection.combined_moments(row["moments"])
        found = [searches[k][name].value for name in fractions]
        return feature, row["n"], row["rows"] - row["n"], row["least"], *found, row["most"], mean, deviation

    schema = ", ".join(
        ["feature STRING, non_null_count BIGINT, null_count BIGINT, min_value DOUBLE"]
        + [f"`{name}` DOUBLE" for name in fractions]
        + ["max_value DOUBLE, avg_value DOUBLE, stddev_value DOUBLE"]
    )
    return df.sparkSession.createDataFrame([summary(k, c) for k, c in enumerate(columns)], schema)


def column_catalogue(df: DataFrame) -> DataFrame:
    """Name, type and nullability of each column, as declared; no row is read.

    :func:`null_profile` tells where values are in fact missing.
    """
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "name STRING, type STRING, nullable BOOLEAN")
