from datetime import date

import pytest
from pyspark.sql import functions as F

from lendspark.constants import LOAN_COLUMNS, LOAN_SCHEMA
from lendspark.functions.buckets import bucket
from lendspark.constants import PROFILE_BUCKETS, REPORT_DTI_BUCKETS, REPORT_FICO_BUCKETS
from lendspark.operators import cleaning, validation
from lendspark.operators.rates import outcome_rates
from lendspark.functions.dates import epoch_ms_to_date
from lendspark.plans.business import default_rate_by_fico, default_rate_by_dti


def raw_rows(spark, *rows):
    schema = ", ".join(f"{name} STRING" for name in LOAN_COLUMNS)
    return spark.createDataFrame(
        [tuple(row.get(name) for name in LOAN_COLUMNS) for row in rows], schema
    )


def test_reject_reasons_and_precedence(spark):
    raw = raw_rows(
        spark,
        {"id": "1", "issue_d": "Dec-2015"},
        {"id": "2", "issue_d": ""},
        {"id": "", "issue_d": "broken"},
        {"id": "Total amount funded"},
        {"id": "3", "issue_d": "2015-12"},
        {"id": "4", "issue_d": "Dec-2015", "earliest_cr_line": "?"},
    )
    assert cleaning.clean_report(raw).first().asDict() == {
        "rows_written": 2,
        "skipped_id": 2,
        "skipped_dates": 2,
    }
    assert sorted(r["id"] for r in cleaning.clean_loans(raw).collect()) == [1, 2]


def test_clean_loans_types_and_order(spark):
    cleaned = cleaning.clean_loans(
        raw_rows(
            spark,
            {"id": "5.0", "term": " 36 months", "int_rate": " 7.5%", "grade": " A ", "dti": "n/a"},
        )
    )
    assert cleaned.columns == LOAN_COLUMNS
    assert [t for _, t in cleaned.dtypes] == [f.dataType.simpleString() for f in LOAN_SCHEMA]
    row = cleaned.first()
    assert (row["id"], row["term"], row["int_rate"], row["grade"], row["dti"]) == (
        5,
        36,
        7.5,
        "A",
        None,
    )


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Pacific/Auckland"])
def test_epoch_ms_is_independent_of_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(0,), (86_399_999,), (86_400_000,), (-1,), (None,)], "ms BIGINT")
        got = [r[0] for r in df.select(epoch_ms_to_date(F.col("ms"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [date(1970, 1, 1), date(1970, 1, 1), date(1970, 1, 2), date(1969, 12, 31), None]


def test_restore_dates_leaves_dates_alone(spark):
    df = spark.sql("SELECT 86400000L AS issue_d, DATE'2001-02-03' AS earliest_cr_line")
    row = cleaning.restore_dates(df).first()
    assert (row["issue_d"], row["earliest_cr_line"]) == (date(1970, 1, 2), date(2001, 2, 3))


def labels(spark, buckets, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v DOUBLE")
    rows = df.select("i", bucket(F.col("v"), buckets).alias("b")).orderBy("i").collect()
    return [row["b"] for row in rows]


def test_bucket_edges(spark):
    assert labels(
        spark, PROFILE_BUCKETS["dti"], [None, -1.0, 0.0, 9.99, 10.0, 40.0, 100.0, 100.01, 999.0]
    ) == ["NULL", "<0", "00-10", "00-10", "10-20", "40-100", "40-100", "100+", "100+"]
    assert labels(spark, REPORT_DTI_BUCKETS, [39.9, 40.0, 100.0]) == ["30-40", "40+", "40+"]


def test_unknown_fico_counts_as_the_top_bucket(spark):
    assert labels(spark, REPORT_FICO_BUCKETS, [None, 649.0, 650.0, 750.0]) == [
        "750+",
        "610-650",
        "650-675",
        "750+",
    ]
    loans = spark.createDataFrame(
        [("Fully Paid", None, None), ("Charged Off", 800, 804)],
        "loan_status STRING, fico_range_low INT, fico_range_high INT",
    )
    row = default_rate_by_fico(loans).collect()
    assert [tuple(r) for r in row] == [("750+", 802.0, 2, 50.0)]


def test_dti_report_leaves_sentinels_out(spark):
    loans = spark.createDataFrame(
        [("Fully Paid", x, 1.0) for x in (None, -1.0, 999.0, 100.0, 40.0)],
        "loan_status STRING, dti DOUBLE, int_rate DOUBLE",
    )
    assert [tuple(r) for r in default_rate_by_dti(loans).collect()] == [("40+", 2, 0, 0.0, 1.0)]


def test_outcome_rates_ignore_open_loans(spark):
    statuses = ["Current", "Default", "Fully Paid", None, "Late (31-120 days)", "Charged Off"]
    loans = spark.createDataFrame([("x", s) for s in statuses], "g STRING, loan_status STRING")
    row = outcome_rates(loans, [F.col("g")]).first()
    assert (row["total_loans"], row["defaulted"], row["fully_paid"]) == (3, 2, 1)
    assert row["default_rate"] == 66.67


RULES = {"positive": "x > 0", "ordered": "x <= y"}


def checked(spark):
    return spark.createDataFrame(
        [(1, 1, 2), (2, -1, 2), (2, 5, 2), (None, -3, -9), (4, None, 1)], "id INT, x INT, y INT"
    )


def test_rules_let_unknown_pass(spark):
    counts = {r["rule"]: r["violations"] for r in validation.check_rules(checked(spark), RULES).collect()}
    assert counts == {"positive": 2, "ordered": 2}


def test_check_key(spark):
    assert tuple(validation.check_key(checked(spark)).first()) == (1, 1, 1)


def test_quarantine_splits_completely(spark):
    good, bad = validation.quarantine(checked(spark), RULES)
    assert good.count() == 2
    assert sorted(r["violated"] for r in bad.collect()) == ["ordered", "positive", "positive,ordered"]


def test_enforce(spark):
    with pytest.raises(validation.ConstraintViolation) as caught:
        validation.enforce(checked(spark), RULES)
    assert caught.value.counts == {"positive": 2, "ordered": 2, "id_not_null": 1, "id_unique": 1}
    fine = checked(spark).where("id = 1")
    assert validation.enforce(fine, RULES) is fine


def test_fields_of_a_record_are_parsed_once(spark, tmp_path):
    """The filter does not have each record taken apart again for every column it uses."""
    from lendspark.sources import readers

    file = tmp_path / "raw.csv"
    file.write_text(",".join(LOAN_COLUMNS) + '\n7,"two\nlines"' + "," * (len(LOAN_COLUMNS) - 2) + "\n")
    cleaned = cleaning.clean_loans(readers.read_raw_csv(spark, str(file)))
    plan = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == 1
    assert [row["id"] for row in cleaned.collect()] == [7]
