"""Profiles kept up to date by reading only the partitions that changed.

Counts of NULLs, values and buckets add up, so a profile of a table is the sum of those of
its partitions. These partial counts are stored per partition value, together with the
version of the files they were counted from; a refresh compares versions, counts the
partitions that are new or different again, drops those that are gone, and publishes the
new state as a whole. A reader sees one state or the next.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.constants import Buckets
from lendspark.functions.buckets import bucket
from lendspark.functions.measures import percent, row_count
from lendspark.operators.profile import with_share
from lendspark.sources import versions

ROWS, NULLS, VALUE, BUCKET = "rows", "nulls", "value", "bucket"
STATE = "part STRING, version BIGINT, kind STRING, feature STRING, value STRING, n BIGINT"
FOLDER = "states"


@dataclass(frozen=True)
class Profile:
    """What is counted: NULLs of ``columns``, values of ``categories``, rows per bucket."""

    columns: Sequence[str]
    categories: Sequence[str] = ()
    buckets: Mapping[str, Buckets] | None = None

    def key(self) -> int:
        """Another profile starts its counts anew."""
        parts = [sorted(self.columns), sorted(self.categories), sorted((self.buckets or {}).items())]
        return crc32(repr(parts).encode())


def partition_versions(table: DataFrame, partition: str) -> DataFrame:
    """``part, version``: per partition value, a number that follows from its files.

    Only names, sizes and times of files are read, no column.
    """
    files = table.select(
        F.col(partition).cast("string").alias("part"),
        F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").alias("file"),
    ).distinct()
    return files.groupBy("part").agg(F.bit_xor("file").alias("version"))


def _within(partition: str, parts: Sequence[str | None]) -> Column:
    named = F.col(partition).cast("string").isin([p for p in parts if p is not None])
    return named | F.col(partition).isNull() if None in parts else named


def count_parts(table: DataFrame, partition: str, profile: Profile) -> DataFrame:
    """``part, kind, feature, value, n`` of every partition in ``table``, in one pass."""
    entry = lambda kind, feature, value: F.struct(
        F.lit(kind).alias("kind"), F.lit(feature).alias("feature"), value.cast("string").alias("value")
    )
    nothing = F.lit(None)
    entries = [entry(ROWS, None, nothing)]
    entries += [F.when(F.col(c).isNull(), entry(NULLS, c, nothing)) for c in profile.columns]
    entries += [
        entry(VALUE, c, F.coalesce(F.col(c).cast("string"), F.lit("NULL"))) for c in profile.categories
    ]
    entries += [entry(BUCKET, c, bucket(F.col(c), b)) for c, b in (profile.buckets or {}).items()]
    return (
        table.select(F.col(partition).cast("string").alias("part"), F.inline(F.array_compact(F.array(*entries))))
        .groupBy("part", "kind", "feature", "value")
        .agg(row_count().alias("n"))
    )


def stored_states(spark: SparkSession, root: str) -> DataFrame | None:
    """The state published last, or None."""
    found = versions.manifests(spark, root)
    return spark.read.schema(STATE).parquet(f"{root}/{found[-1]['folder']}/{FOLDER}") if found else None


def refresh(table: DataFrame, partition: str, profile: Profile, root: str) -> list[str | None]:
    """Bring the state at ``root`` up to date; returns the partition values read again.

    There is a row per partition value on the driver.
    """
    spark = table.sparkSession
    key = F.lit(profile.key())
    now = {
        row["part"]: row["version"]
        for row in partition_versions(table, partition).select("part", F.col("version").bitwiseXOR(key).alias("version")).collect()
    }
    states = stored_states(spark, root)
    before = {}
    if states is not None:
        before = {row["part"]: row["version"] for row in states.select("part", "version").distinct().collect()}
    changed = [part for part, version in now.items() if before.get(part) != version]
    gone = [part for part in before if part not in now]
    if not changed and not gone and states is not None:
        return []
    counted = count_parts(table.where(_within(partition, changed)), partition, profile)
    names = spark.createDataFrame([(part, now[part]) for part in changed], "part STRING, version BIGINT")
    fresh = counted.join(F.broadcast(names), counted["part"].eqNullSafe(names["part"])).select(
        counted["part"], "version", "kind", "feature", "value", "n"
    )
    if states is not None:
        kept = states.where(~F.coalesce(_within("part", changed + gone), F.lit(False)))
        fresh = kept.unionByName(fresh)
    versions.publish_package(spark, root, {FOLDER: lambda path: fresh.write.parquet(path)})
    return changed


def _counts(states: DataFrame, kind: str, *by: str) -> DataFrame:
    return states.where(F.col("kind") == kind).groupBy(*by).agg(F.sum("n").alias("count"))


def null_profile(states: DataFrame, columns: Sequence[str]) -> DataFrame:
    """As :func:`lendspark.operators.profile.null_profile`, from a state."""
    total = states.where(F.col("kind") == ROWS).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"))
    counts = _counts(states, NULLS, "feature")
    names = states.sparkSession.createDataFrame([(c,) for c in columns], "column_name STRING")
    null_count = F.coalesce("count", F.lit(0))
    return (
        names.join(counts, names["column_name"] == counts["feature"], "left")
        .crossJoin(F.broadcast(total))
        .select(
            "column_name",
            null_count.alias("null_count"),
            "total_rows",
            percent(null_count, F.col("total_rows"), 4).alias("null_pct"),
        )
    )


def value_counts(states: DataFrame) -> DataFrame:
    """As :func:`lendspark.operators.profile.value_counts`, from a state."""
    return with_share(_counts(states, VALUE, "feature", "value"), ["feature"])


def distribution(states: DataFrame) -> DataFrame:
    """As :func:`lendspark.operators.profile.distribution`, from a state."""
    counts = _counts(states, BUCKET, "feature", "value").withColumnRenamed("value", "bucket")
    return with_share(counts, ["feature"])
