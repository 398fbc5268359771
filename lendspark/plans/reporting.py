"""Publishing of every report: tables with statistics, and files to pass on."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from lendspark.plans import business, quality
from lendspark.sources import catalog, readers, writers

REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {**business.REPORTS, **quality.REPORTS}
SCHEMAS: dict[str, str] = {**business.REPORT_SCHEMAS, **quality.REPORT_SCHEMAS}
# What the rows of an exported file are sorted by.
ORDERS: dict[str, Sequence[str]] = {**business.REPORT_ORDERS, **quality.REPORT_ORDERS}


def publish_reports(
    loans: DataFrame,
    root: str,
    prefix: str = "",
    reports: Mapping[str, Callable[[DataFrame], DataFrame]] = REPORTS,
) -> dict[str, str]:
    """Each report as an ORC table with declared types and statistics, and as CSV.

    Tables lie under ``root/tables``, exports, sorted, under ``root/export``. A report is
    computed once; the export reads its table. Returns the tables by report.
    """
    spark = loans.sparkSession
    tables = {}
    for name, report in reports.items():
        table = f"{prefix}{name}_results"
        writers.publish(report(loans), table, SCHEMAS[name], f"{root}/tables/{name}")
        catalog.analyze(spark, table)
        writers.export_csv(
            readers.read_source(spark, table), f"{root}/export/{name}", order_by=ORDERS[name]
        )
        tables[name] = table
    return tables
