"""Reports on how settled loans ended. Each scans the loans once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.constants import (
    OWNERSHIP_REPORTED,
    REPORT_DTI_BUCKETS,
    REPORT_FICO_BUCKETS,
)
from lendspark.functions.buckets import bucket
from lendspark.operators.rates import outcome_rates


def _average(column: str, digits: int = 2):
    return F.round(F.avg(column), digits).alias(f"avg_{column}")


def default_rate_by_grade(loans: DataFrame) -> DataFrame:
    rates = outcome_rates(loans, [F.col("grade")], [_average("int_rate")])
    return rates.select(
        "grade", "total_loans", "defaulted", "fully_paid", "default_rate", "avg_int_rate"
    ).orderBy("grade")


def default_rate_by_purpose(loans: DataFrame) -> DataFrame:
    """Worst purpose first."""
    rates = outcome_rates(loans, [F.col("purpose")], [_average("loan_amnt")])
    return rates.select(
        "purpose", "total_loans", "defaulted", "default_rate", "avg_loan_amnt"
    ).orderBy(F.desc("default_rate"))


def default_rate_by_year(loans: DataFrame) -> DataFrame:
    rates = outcome_rates(
        loans, [F.year("issue_d").alias("issue_year")], [_average("int_rate")]
    )
    return rates.select(
        "issue_year", "total_loans", "defaulted", "default_rate", "avg_int_rate"
    ).orderBy("issue_year")


def default_rate_by_dti(loans: DataFrame) -> DataFrame:
    """Debt ratios from 0 to 100 only, which leaves the sentinels -1 and 999 out."""
    rates = outcome_rates(
        loans.where(F.col("dti").between(0, 100)),
        [bucket(F.col("dti"), REPORT_DTI_BUCKETS).alias("dti_bucket")],
        [_average("int_rate")],
    )
    return rates.select(
        "dti_bucket", "total_loans", "defaulted", "default_rate", "avg_int_rate"
    ).orderBy("dti_bucket")


def default_rate_by_grade_and_ownership(loans: DataFrame) -> DataFrame:
    rates = outcome_rates(
        loans.where(F.col("home_ownership").isin(OWNERSHIP_REPORTED)),
        [F.col("grade"), F.col("home_ownership")],
    )
    return rates.select("grade", "home_ownership", "total_loans", "default_rate").orderBy(
        "grade", "home_ownership"
    )


def default_rate_by_fico(loans: DataFrame) -> DataFrame:
    middle = (F.col("fico_range_low") + F.col("fico_range_high")) / 2.0
    rates = outcome_rates(
        loans,
        [bucket(F.col("fico_range_low"), REPORT_FICO_BUCKETS).alias("fico_bucket")],
        [F.round(F.avg(middle), 1).alias("avg_fico")],
    )
    return rates.select("fico_bucket", "avg_fico", "total_loans", "default_rate").orderBy(
        "avg_fico"
    )


# Published column types of the reports.
REPORT_SCHEMAS = {
    "q1": "grade STRING, total_loans BIGINT, defaulted BIGINT, fully_paid BIGINT,"
    " default_rate DOUBLE, avg_int_rate DOUBLE",
    "q2": "purpose STRING, total_loans BIGINT, defaulted BIGINT, default_rate DOUBLE,"
    " avg_loan_amnt DOUBLE",
    "q3": "issue_year INT, total_loans BIGINT, defaulted BIGINT, default_rate DOUBLE,"
    " avg_int_rate DOUBLE",
    "q4": "dti_bucket STRING, total_loans BIGINT, defaulted BIGINT, default_rate DOUBLE,"
    " avg_int_rate DOUBLE",
    "q5": "grade STRING, home_ownership STRING, total_loans BIGINT, default_rate DOUBLE",
    "q6": "fico_bucket STRING, avg_fico DOUBLE, total_loans BIGINT, default_rate DOUBLE",
}

REPORTS = {
    "q1": default_rate_by_grade,
    "q2": default_rate_by_purpose,
    "q3": default_rate_by_year,
    "q4": default_rate_by_dti,
    "q5": default_rate_by_grade_and_ownership,
    "q6": default_rate_by_fico,
}

REPORT_ORDERS = {
    "q1": ["grade"],
    "q2": ["purpose"],
    "q3": ["issue_year"],
    "q4": ["dti_bucket"],
    "q5": ["grade", "home_ownership"],
    "q6": ["avg_fico"],
}
