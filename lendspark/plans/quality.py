"""Data-quality reports on the loans table.

Each scans it once, but for the numeric report, which looks again for exact percentiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.constants import (
    BINARY_STATUSES,
    CATEGORICAL_FEATURES,
    CHARGED_OFF,
    LOAN_COLUMNS,
    PROFILE_BUCKETS,
    STORED_NUMERIC_FEATURES,
)
from lendspark.functions.measures import row_count
from lendspark.operators import profile


def null_report(loans: DataFrame) -> DataFrame:
    return profile.null_profile(loans, LOAN_COLUMNS)


def status_report(loans: DataFrame) -> DataFrame:
    return profile.status_distribution(loans).orderBy(F.desc("count"))


def binary_target_report(loans: DataFrame) -> DataFrame:
    status = F.col("loan_status")
    counts = (
        loans.where(status.isin(BINARY_STATUSES))
        .groupBy((status == CHARGED_OFF).cast("int").alias("label"), status)
        .agg(row_count().alias("count"))
    )
    return profile.with_share(counts).orderBy("label")


def categorical_report(loans: DataFrame) -> DataFrame:
    return profile.value_counts(loans, CATEGORICAL_FEATURES)


def numeric_report(loans: DataFrame) -> DataFrame:
    return profile.numeric_summary(loans, STORED_NUMERIC_FEATURES)


def bucket_report(loans: DataFrame) -> DataFrame:
    return profile.distribution(loans, PROFILE_BUCKETS).orderBy("feature", "bucket")


REPORTS = {
    "dq_null_profile": null_report,
    "dq_loan_status_distribution": status_report,
    "dq_binary_target_distribution": binary_target_report,
    "dq_categorical_value_counts": categorical_report,
    "dq_numeric_summary": numeric_report,
    "dq_numeric_distributions": bucket_report,
}

# Published column types of the reports.
_SHARES = "`count` BIGINT, share_pct DOUBLE"
REPORT_SCHEMAS = {
    "dq_null_profile": "column_name STRING, null_count BIGINT, total_rows BIGINT, null_pct DOUBLE",
    "dq_loan_status_distribution": f"loan_status STRING, {_SHARES}",
    "dq_binary_target_distribution": f"label INT, loan_status STRING, {_SHARES}",
    "dq_categorical_value_counts": f"feature STRING, value STRING, {_SHARES}",
    "dq_numeric_summary": "feature STRING, non_null_count BIGINT, null_count BIGINT,"
    " min_value DOUBLE, p25 DOUBLE, median DOUBLE, p75 DOUBLE, p95 DOUBLE, max_value DOUBLE,"
    " avg_value DOUBLE, stddev_value DOUBLE",
    "dq_numeric_distributions": f"feature STRING, bucket STRING, {_SHARES}",
}

REPORT_ORDERS = {
    "dq_null_profile": ["column_name"],
    "dq_loan_status_distribution": ["count", "loan_status"],
    "dq_binary_target_distribution": ["label"],
    "dq_categorical_value_counts": ["feature", "value"],
    "dq_numeric_summary": ["feature"],
    "dq_numeric_distributions": ["feature", "bucket"],
}
