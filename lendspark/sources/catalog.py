"""Catalog work: statistics and the published summary tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lendspark.constants import SUMMARY_SCHEMAS
from lendspark.sources import versions
from lendspark.sources.names import quoted
from lendspark.sources.writers import as_declared, export_csv


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}")


def analyze(spark: SparkSession, table: str, columns: bool = False) -> None:
    """Collect table statistics, and column statistics on request."""
    suffix = " FOR ALL COLUMNS" if columns else ""
    spark.sql(f"ANALYZE TABLE {quoted(table)} COMPUTE STATISTICS{suffix}")


def table_statistics(spark: SparkSession, table: str) -> dict[str, int]:
    """Rows and bytes that the catalog holds for ``table`` after :func:`analyze`."""
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").where("col_name = 'Statistics'")
    parts = details.first()["data_type"].replace(",", "").split()
    return {unit: int(number) for number, unit in zip(parts[::2], parts[1::2])}


def publish_dashboard(summaries: Mapping[str, DataFrame], root: str) -> None:
    """Write the summary tables side by side, and make them the current package together.

    A reader sees the tables of one publication, see :mod:`lendspark.sources.versions`.
    """
    unknown = sorted(set(summaries) - set(SUMMARY_SCHEMAS))
    if unknown:
        raise ValueError(f"Not a summary table: {', '.join(unknown)}")
    if not summaries:
        return
    spark = next(iter(summaries.values())).sparkSession
    writes = {
        name: partial(export_csv, as_declared(df, SUMMARY_SCHEMAS[name])) for name, df in summaries.items()
    }
    versions.publish_package(spark, root, writes)


def register_summaries(
    spark: SparkSession,
    root: str,
    database: str = "default",
    prefix: str = "ml_",
    names: Iterable[str] = tuple(SUMMARY_SCHEMAS),
) -> dict[str, str]:
    """External tables over those folders of :func:`publish_dashboard` that ``names`` tells.

    All of them belong to the latest publication at the time of the call.
    Quoted fields are honoured, so parameter text with commas stays whole.
    """
    tables = {}
    folder = versions.current_package(spark, root)
    for name in names:
        table = f"{database}.{prefix}{name}"
        spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")
        spark.catalog.createTable(
            quoted(table),
            path=f"{folder}/{name}",
            source="csv",
            schema=T.StructType.fromDDL(SUMMARY_SCHEMAS[name]),
            header="true",
            escape='"',
        )
        tables[name] = quoted(table)
    return tables
