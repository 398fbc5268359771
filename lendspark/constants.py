"""Names, labels and limits that results depend on.

Everything below is a fixed value: changing one changes published results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: table layout ------------------------------------------------

LOAN_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("loan_amnt", T.DoubleType()),
        T.StructField("term", T.IntegerType()),
        T.StructField("int_rate", T.DoubleType()),
        T.StructField("installment", T.DoubleType()),
        T.StructField("grade", T.StringType()),
        T.StructField("sub_grade", T.StringType()),
        T.StructField("emp_length", T.StringType()),
        T.StructField("home_ownership", T.StringType()),
        T.StructField("annual_inc", T.DoubleType()),
        T.StructField("verification_status", T.StringType()),
        T.StructField("purpose", T.StringType()),
        T.StructField("dti", T.DoubleType()),
        T.StructField("delinq_2yrs", T.IntegerType()),
        T.StructField("inq_last_6mths", T.IntegerType()),
        T.StructField("open_acc", T.IntegerType()),
        T.StructField("pub_rec", T.IntegerType()),
        T.StructField("revol_bal", T.LongType()),
        T.StructField("revol_util", T.DoubleType()),
        T.StructField("total_acc", T.IntegerType()),
        T.StructField("application_type", T.StringType()),
        T.StructField("fico_range_low", T.IntegerType()),
        T.StructField("fico_range_high", T.IntegerType()),
        T.StructField("issue_d", T.DateType()),
        T.StructField("earliest_cr_line", T.DateType()),
        T.StructField("loan_status", T.StringType()),
    ]
)
LOAN_COLUMNS = LOAN_SCHEMA.fieldNames()

DATE_COLUMNS = ["issue_d", "earliest_cr_line"]

# The staged copy carries its dates as epoch milliseconds.
STAGED_LOAN_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.LongType() if f.name in DATE_COLUMNS else f.dataType)
        for f in LOAN_SCHEMA
    ]
)

# --- fixed values: outcomes ----------------------------------------------------

FULLY_PAID = "Fully Paid"
CHARGED_OFF = "Charged Off"

PAID_STATUSES = [FULLY_PAID, "Does not meet the credit policy. Status:Fully Paid"]
BAD_STATUSES = [
    CHARGED_OFF,
    "Default",
    "Does not meet the credit policy. Status:Charged Off",
]
SETTLED_STATUSES = PAID_STATUSES + BAD_STATUSES

# Classification uses the two plain outcomes only.
BINARY_STATUSES = [FULLY_PAID, CHARGED_OFF]

OWNERSHIP_REPORTED = ["RENT", "OWN", "MORTGAGE"]

# --- fixed values: buckets -----------------------------------------------------


@dataclass(frozen=True)
class Buckets:
    """Labelled intervals over a number.

    ``below`` holds ``(upper, label)`` pairs in ascending order, each taking
    values under its bound. ``up_to`` is one further pair whose bound is
    included. Whatever is left gets ``rest``. NULL gets ``null_label``, or falls
    to ``rest`` when there is none.
    """

    below: tuple[tuple[float, str], ...]
    rest: str
    up_to: tuple[float, str] | None = None
    null_label: str | None = "NULL"


FICO_STEPS = (
    (650, "610-650"),
    (675, "650-675"),
    (700, "675-700"),
    (725, "700-725"),
    (750, "725-750"),
)

# NULL is not singled out in the two report scales: an unknown score counts as
# the top bucket, and an unknown ratio is filtered out beforehand.
REPORT_DTI_BUCKETS = Buckets(
    below=((10, "00-10"), (20, "10-20"), (30, "20-30"), (40, "30-40")),
    rest="40+",
    null_label=None,
)
REPORT_FICO_BUCKETS = Buckets(below=FICO_STEPS, rest="750+", null_label=None)

PROFILE_BUCKETS = {
    "loan_amnt": Buckets(
        below=(
            (5000, "00000-05000"),
            (10000, "05000-10000"),
            (15000, "10000-15000"),
            (20000, "15000-20000"),
            (30000, "20000-30000"),
        ),
        rest="30000+",
    ),
    "annual_inc": Buckets(
        below=(
            (25000, "000000-025000"),
            (50000, "025000-050000"),
            (75000, "050000-075000"),
            (100000, "075000-100000"),
            (150000, "100000-150000"),
        ),
        rest="150000+",
    ),
    "dti": Buckets(
        below=(
            (0, "<0"),
            (10, "00-10"),
            (20, "10-20"),
            (30, "20-30"),
            (40, "30-40"),
        ),
        up_to=(100, "40-100"),
        rest="100+",
    ),
    "int_rate": Buckets(
        below=(
            (5, "00-05"),
            (10, "05-10"),
            (15, "10-15"),
            (20, "15-20"),
            (25, "20-25"),
        ),
        rest="25+",
    ),
    "revol_util": Buckets(
        below=(
            (0, "<0"),
            (20, "000-020"),
            (40, "020-040"),
            (60, "040-060"),
            (80, "060-080"),
        ),
        up_to=(100, "080-100"),
        rest="100+",
    ),
    "fico_range_low": Buckets(below=FICO_STEPS, rest="750+"),
}

# --- fixed values: profiled columns and features -------------------------------

CATEGORICAL_FEATURES = [
    "grade",
    "sub_grade",
    "emp_length",
    "home_ownership",
    "verification_status",
    "purpose",
    "application_type",
]
STORED_NUMERIC_FEATURES = [
    "loan_amnt",
    "term",
    "int_rate",
    "installment",
    "annual_inc",
    "dti",
    "delinq_2yrs",
    "inq_last_6mths",
    "open_acc",
    "pub_rec",
    "revol_bal",
    "revol_util",
    "total_acc",
    "fico_range_low",
    "fico_range_high",
]
DATE_FEATURES = [
    "issue_year",
    "issue_month",
    "issue_month_sin",
    "issue_month_cos",
    "credit_history_months",
]
NUMERIC_FEATURES = STORED_NUMERIC_FEATURES + DATE_FEATURES

PREPARED_COLUMNS = (
    ["id", "loan_status", "label", "issue_d"]
    + STORED_NUMERIC_FEATURES
    + CATEGORICAL_FEATURES
    + DATE_FEATURES
)

PERCENTILES = {"p25": "0.25", "median": "0.50", "p75": "0.75", "p95": "0.95"}

# --- fixed values: integrity rules ---------------------------------------------
# SQL conditions that every row has to meet; an unknown result passes, as it does
# in a CHECK constraint.

LOAN_RULES = {
    "nonnegative_counts": (
        "delinq_2yrs >= 0 AND inq_last_6mths >= 0 AND open_acc >= 0"
        " AND pub_rec >= 0 AND total_acc >= 0"
    ),
    "fico_order": "fico_range_low <= fico_range_high",
    "term_positive": "term > 0",
    "revol_bal_nonnegative": "revol_bal >= 0",
    "numeric_domains": (
        "loan_amnt > 0 AND installment >= 0 AND annual_inc >= 0"
        " AND int_rate BETWEEN 0 AND 100 AND revol_util >= 0"
        " AND dti >= -1 AND dti < 1e7D"
    ),
}

# --- fixed values: training defaults -------------------------------------------

SEED = 42
SPLIT_CUTOFF = "2016-04-01"
MIN_TRAIN_SHARE = 0.6
CV_FOLDS = 3
CV_PARALLELISM = 2
CV_METRIC = "areaUnderPR"

# --- fixed values: published summary tables ------------------------------------

_METRIC_FIELDS = (
    "model STRING, accuracy DOUBLE, `precision` DOUBLE, recall DOUBLE, f1 DOUBLE,"
    " areaUnderROC DOUBLE, areaUnderPR DOUBLE,"
    " tp BIGINT, tn BIGINT, fp BIGINT, fn BIGINT"
)
SUMMARY_SCHEMAS = {
    "split_summary": "dataset STRING, `rows` BIGINT, feature_count INT",
    "feature_info": "feature_name STRING, feature_type STRING",
    "label_distribution": "dataset STRING, label DOUBLE, `count` BIGINT, share DOUBLE",
    "baseline_evaluation": _METRIC_FIELDS,
    "evaluation": _METRIC_FIELDS + ", best_params STRING",
    "prediction_distribution": (
        "model STRING, label DOUBLE, prediction DOUBLE, `count` BIGINT"
    ),
}
