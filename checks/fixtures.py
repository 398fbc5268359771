"""Loan-shaped views of the shared test tables.

Each statement means the same to Spark and to DuckDB; ``FIXTURES.md`` describes
them. Names in braces stand for the tables or views read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The test data starts in 1995 and ends in 2001, so the split falls in between.
FIXTURE_CUTOFF = "1999-07-01"

LOANS = """
SELECT o_orderkey AS id,
  CAST(floor(o_totalprice / 125e-1) AS DOUBLE) AS loan_amnt,
  CASE WHEN o_orderkey % 3 = 0 THEN 60 ELSE 36 END AS term,
  5e0 + (o_orderkey % 101) * 25e-2 AS int_rate,
  CAST(floor(o_totalprice / 4e2) AS DOUBLE) AS installment,
  substring('ABCDEFG', CAST(1 + o_orderkey % 7 AS INT), 1) AS grade,
  concat(substring('ABCDEFG', CAST(1 + o_orderkey % 7 AS INT), 1), substring('12345', CAST(1 + o_custkey % 5 AS INT), 1)) AS sub_grade,
  CASE WHEN o_orderkey % 16 = 0 THEN NULL WHEN o_custkey % 11 = 0 THEN '< 1 year' WHEN o_custkey % 11 = 10 THEN '10+ years' ELSE concat(CAST(o_custkey % 11 AS VARCHAR(2)), ' years') END AS emp_length,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'MORTGAGE' WHEN 'HOUSEHOLD' THEN 'OWN' WHEN 'AUTOMOBILE' THEN 'RENT' WHEN 'MACHINERY' THEN 'ANY' ELSE 'RENT' END AS home_ownership,
  CASE WHEN o_orderkey % 500 = 7 THEN NULL ELSE CAST(floor((c_acctbal + 1e3) * 15e0) AS DOUBLE) END AS annual_inc,
  CASE o_orderkey % 3 WHEN 0 THEN 'Verified' WHEN 1 THEN 'Source Verified' ELSE 'Not Verified' END AS verification_status,
  lower(substring(o_orderpriority, 3)) AS purpose,
  CASE WHEN o_orderkey % 200 = 3 THEN NULL WHEN o_orderkey % 200 = 4 THEN -1e0 WHEN o_orderkey % 200 = 5 THEN 999e0 ELSE (o_orderkey % 97) * 5e-1 END AS dti,
  CASE WHEN o_orderkey % 300 = 11 THEN NULL ELSE CAST(o_custkey % 4 AS INT) END AS delinq_2yrs,
  CAST(o_custkey % 6 AS INT) AS inq_last_6mths,
  CAST(1 + o_custkey % 30 AS INT) AS open_acc,
  CAST(o_orderkey % 2 AS INT) AS pub_rec,
  CAST(floor(o_totalprice / 2e1) AS BIGINT) AS revol_bal,
  CASE WHEN o_orderkey % 250 = 9 THEN NULL ELSE (o_orderkey % 211) * 5e-1 END AS revol_util,
  CAST(2 + o_custkey % 60 AS INT) AS total_acc,
  CASE WHEN o_orderkey % 20 = 0 THEN 'Joint App' ELSE 'Individual' END AS application_type,
  CAST(610 + 5 * (o_orderkey % 47) AS INT) AS fico_range_low,
  CAST(614 + 5 * (o_orderkey % 47) AS INT) AS fico_range_high,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS issue_d,
  CASE WHEN o_orderkey % 300 = 11 THEN NULL ELSE make_date(CAST(1970 + o_custkey % 24 AS INT), CAST(1 + o_custkey % 12 AS INT), 1) END AS earliest_cr_line,
  CASE WHEN o_orderkey % 211 = 0 THEN 'Default'
       WHEN o_orderkey % 211 = 1 THEN 'Does not meet the credit policy. Status:Charged Off'
       WHEN o_orderkey % 211 = 2 THEN 'Does not meet the credit policy. Status:Fully Paid'
       WHEN o_orderkey % 211 = 3 THEN NULL
       WHEN o_orderkey % 211 = 4 THEN 'Late (31-120 days)'
       WHEN o_orderstatus = 'P' THEN 'Current'
       WHEN (o_orderkey * 7 + o_custkey) % 10 < 1 + (o_orderkey % 7) * 6e-1 THEN 'Charged Off'
       ELSE 'Fully Paid' END AS loan_status
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

# Per published report: the query it equals, a column to count by and one to add up.
PUBLISHED = {
    "q1": ("q1_grade", "total_loans", "default_rate"),
    "q2": ("q2_purpose", "total_loans", "default_rate"),
    "q3": ("q3_issue_year", "total_loans", "default_rate"),
    "q4": ("q4_dti", "total_loans", "default_rate"),
    "q5": ("q5_grade_ownership", "total_loans", "default_rate"),
    "q6": ("q6_fico", "total_loans", "default_rate"),
    "dq_null_profile": ("dq_null_profile", "null_count", "null_pct"),
    "dq_loan_status_distribution": ("dq_status_distribution", "count", "share_pct"),
    "dq_binary_target_distribution": ("dq_binary_target", "count", "share_pct"),
    "dq_categorical_value_counts": ("dq_categorical_counts", "count", "share_pct"),
    "dq_numeric_summary": ("dq_numeric_summary", "non_null_count", "median"),
    "dq_numeric_distributions": ("dq_numeric_distributions", "count", "share_pct"),
}

# As exported: text throughout, with blanks, percent signs and broken fields.
LOANS_RAW = """
SELECT CASE WHEN id % 401 = 0 THEN '' WHEN id % 401 = 1 THEN 'Total amount funded' WHEN id % 401 = 2 THEN concat(CAST(id AS VARCHAR(20)), '.0') ELSE CAST(id AS VARCHAR(20)) END AS id,
  CAST(CAST(floor(loan_amnt) AS BIGINT) AS VARCHAR(20)) AS loan_amnt,
  CASE WHEN id % 103 = 4 THEN ' 0 months' ELSE concat(' ', CAST(term AS VARCHAR(3)), ' months') END AS term,
  concat(' ', CAST(CAST(floor(int_rate) AS INT) AS VARCHAR(4)), '.25%') AS int_rate,
  CAST(CAST(floor(installment) AS BIGINT) AS VARCHAR(20)) AS installment,
  concat(' ', grade) AS grade, sub_grade,
  emp_length,
  concat('  ', home_ownership, ' ') AS home_ownership,
  CASE WHEN id % 613 = 7 THEN '1e999' ELSE CAST(CAST(floor(annual_inc) AS BIGINT) AS VARCHAR(20)) END AS annual_inc,
  CASE WHEN id % 17 = 0 THEN concat('say "', verification_status, '", twice', chr(10), 'over') ELSE verification_status END AS verification_status, purpose,
  CAST(CAST(floor(dti) AS BIGINT) AS VARCHAR(20)) AS dti,
  CASE WHEN delinq_2yrs IS NULL THEN NULL WHEN id % 13 = 0 THEN 'n/a' ELSE concat(CAST(delinq_2yrs AS VARCHAR(20)), '.0') END AS delinq_2yrs,
  concat(CAST(inq_last_6mths AS VARCHAR(20)), '.0') AS inq_last_6mths, concat(CAST(open_acc AS VARCHAR(20)), '.0') AS open_acc, concat(CAST(pub_rec AS VARCHAR(20)), '.0') AS pub_rec,
  concat(CAST(revol_bal AS VARCHAR(20)), '.0') AS revol_bal,
  CASE WHEN revol_util IS NULL THEN '' ELSE concat(CAST(CAST(floor(revol_util) AS BIGINT) AS VARCHAR(20)), '.5%') END AS revol_util,
  concat(CAST(total_acc AS VARCHAR(20)), '.0') AS total_acc, application_type,
  concat(CAST(fico_range_low AS VARCHAR(20)), '.0') AS fico_range_low, concat(CAST(fico_range_high AS VARCHAR(20)), '.0') AS fico_range_high,
  CASE WHEN id % 307 = 5 THEN 'Xyz-2015' ELSE concat(substring('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(3 * (month(issue_d) - 1) + 1 AS INT), 3), '-', CAST(year(issue_d) AS VARCHAR(4))) END AS issue_d,
  CASE WHEN earliest_cr_line IS NULL THEN '' WHEN id % 311 = 6 THEN '2003/08' ELSE concat(substring('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(3 * (month(earliest_cr_line) - 1) + 1 AS INT), 3), '-', CAST(year(earliest_cr_line) AS VARCHAR(4))) END AS earliest_cr_line,
  loan_status,
  'x' AS url
FROM {loans}
"""

# Dates as epoch milliseconds, the way a database snapshot delivers them.
LOANS_STAGED_SPARK = """
SELECT * EXCEPT (issue_d, earliest_cr_line),
  unix_millis(CAST(issue_d AS TIMESTAMP)) AS issue_d,
  unix_millis(CAST(earliest_cr_line AS TIMESTAMP)) AS earliest_cr_line
FROM {loans}
"""

# Loans with broken keys and broken rules.
LOANS_BROKEN = """
SELECT CASE WHEN id % 397 = 0 THEN NULL WHEN id % 211 = 5 THEN id - 5 ELSE id END AS id,
  CASE WHEN id % 101 = 3 THEN -1 * loan_amnt ELSE loan_amnt END AS loan_amnt,
  CASE WHEN id % 103 = 4 THEN 0 ELSE term END AS term,
  CASE WHEN id % 107 = 5 THEN 1005e-1 ELSE int_rate END AS int_rate,
  installment, annual_inc, revol_util,
  CASE WHEN id % 109 = 6 THEN 1e7 ELSE dti END AS dti,
  CASE WHEN id % 113 = 7 THEN -1 ELSE delinq_2yrs END AS delinq_2yrs,
  inq_last_6mths, open_acc, pub_rec, total_acc,
  CASE WHEN id % 127 = 8 THEN -5 ELSE revol_bal END AS revol_bal,
  CASE WHEN id % 131 = 9 THEN fico_range_high + 1 ELSE fico_range_low END AS fico_range_low,
  fico_range_high
FROM {loans}
"""

# Predictions made up of plain arithmetic.
SCORES = """
SELECT id, label, score, CAST(CASE WHEN score >= 5e-1 THEN 1 ELSE 0 END AS DOUBLE) AS prediction FROM (
  SELECT id, label, (CAST((id * 37 + fico_range_low) % 800 AS DOUBLE) + 2e2 * label) / 1e3 AS score FROM (
    SELECT id, fico_range_low, CAST(CASE WHEN loan_status = 'Charged Off' THEN 1 ELSE 0 END AS DOUBLE) AS label
    FROM {loans} WHERE loan_status IN ('Fully Paid', 'Charged Off')) a) b
"""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        LOANS,
        orders=read_table(spark, sf_dir, "orders"),
        customer=read_table(spark, sf_dir, "customer"),
    )


def over_loans(spark: SparkSession, sf_dir: str, statement: str) -> DataFrame:
    return spark.sql(statement, loans=loans(spark, sf_dir))


def loans_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return over_loans(spark, sf_dir, LOANS_RAW)


def loans_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return over_loans(spark, sf_dir, LOANS_STAGED_SPARK)


def loans_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    return over_loans(spark, sf_dir, LOANS_BROKEN)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return over_loans(spark, sf_dir, SCORES)
