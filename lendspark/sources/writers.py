"""Sinks. Every write replaces its target, so a second run adds nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


# Rows that one range of a snapshot holds, about.
RANGE_ROWS = 1 << 20


def snapshot(df: DataFrame, path: str, key: str = "id", splits: int | None = None) -> None:
    """Parquet copy in key ranges, so that files prune on the key.

    ``splits`` is the number of files, but for tables that need more to keep each range to
    about ``RANGE_ROWS`` rows; left out, Spark sizes them.
    """
    if splits is None:
        ranges = df.repartitionByRange(key)
    else:
        ranges = df.repartitionByRange(max(splits, -(-df.count() // RANGE_ROWS)), key)
    write_parquet(ranges, path)


def save_table(
    df: DataFrame, table: str, fmt: str = "parquet", path: str | None = None
) -> None:
    """Create or replace a table from ``df``."""
    writer = df.write.mode("overwrite").format(fmt)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_curated(
    df: DataFrame,
    table: str,
    partition: str = "grade",
    bucket_key: str = "id",
    buckets: int = 8,
    path: str | None = None,
) -> None:
    """Partitioned and bucketed Snappy Parquet table.

    Rows are brought together by partition value and bucket first, so the number
    of files follows the layout rather than the number of tasks. It is a rebalance,
    not a plain repartition: a partition value holding much of the table is split
    over several tasks by size. Raise ``buckets`` with the table.
    """
    together = df.withColumn("_bucket", F.pmod(F.hash(bucket_key), F.lit(buckets)))
    writer = (
        together.hint("rebalance", partition, "_bucket")
        .drop("_bucket")
        .write.mode("overwrite")
        .format("parquet")
        .option("compression", "snappy")
        .partitionBy(partition)
        .bucketBy(buckets, bucket_key)
    )
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_colocated(
    df: DataFrame, table: str, path: str, key: str = "id", buckets: int = 8
) -> DataFrame:
    """``df`` as a table in ``buckets`` files by ``key``, each sorted by it; returns the table.

    Tables of as many buckets are joined on the key where they lie: no row moves. One
    shuffle per table pays for all joins to come. Set ``buckets`` for the largest table.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def publish(
    df: DataFrame,
    table: str,
    schema: T.StructType | str | None = None,
    path: str | None = None,
) -> None:
    """Result table in ORC, with declared column types if given."""
    if schema is not None:
        df = as_declared(df, schema)
    save_table(df, table, "orc", path)


def as_declared(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """``df`` in the column order and types of ``schema``."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def export_csv(df: DataFrame, path: str, order_by: Sequence[str] = ()) -> None:
    """Headered CSV directory; a small result comes out as one file.

    Adaptive execution merges small partitions into one and leaves a large result
    in many, so nothing big is ever squeezed through a single task.
    """
    df = df.orderBy(*order_by) if order_by else df.hint("rebalance")
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def save_json_artifact(df: DataFrame, path: str) -> None:
    """Features and labels as JSON lines, one file per partition."""
    df.select("features", "label").write.mode("overwrite").json(path)


def save_predictions(predictions: DataFrame, path: str) -> None:
    """True and predicted label of every row as headered CSV."""
    predictions.select("label", "prediction").write.mode("overwrite").csv(path, header=True)


def save_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)
