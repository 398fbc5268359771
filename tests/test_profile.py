import math
import random
from decimal import ROUND_CEILING, Decimal

from pyspark.sql import functions as F

from lendspark.constants import PROFILE_BUCKETS
from lendspark.operators import profile
from lendspark.operators.running import key_ranges, running_totals
from lendspark.plans import business, quality


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_running_totals_match_a_plain_loop(spark, tmp_path):
    random.seed(1)
    rows = [(g, k, random.randint(0, 9)) for g in ("a", "b") for k in random.sample(range(5000), 900)]
    df = spark.createDataFrame(rows, "g STRING, k INT, n INT").repartition(7)
    order = [F.col("k").desc()]
    ranges = key_ranges(df, order, str(tmp_path / "ranges"), ["g"])
    got = running_totals(ranges, ["n"], order, ["g"])
    expected = {}
    for g in ("a", "b"):
        total = 0
        for _, k, n in sorted((r for r in rows if r[0] == g), key=lambda r: -r[1]):
            total += n
            expected[g, k] = total
    assert {(r["g"], r["k"]): r["cum_n"] for r in got.collect()} == expected


def test_numeric_summary_against_brute_force(spark):
    random.seed(2)
    columns = {
        "many": [random.choice([None, random.uniform(-1e6, 1e6)]) for _ in range(3001)],
        "hot": [7.0 if random.random() < 0.6 else float(random.randint(0, 20)) for _ in range(3001)],
        "empty": [None] * 3001,
    }
    rows = list(zip(*columns.values()))
    df = spark.createDataFrame(rows, "many DOUBLE, hot DOUBLE, empty DOUBLE").repartition(5)
    got = {r["feature"]: r for r in profile.numeric_summary(df, list(columns)).collect()}
    assert set(got) == set(columns)
    for name in ("many", "hot"):
        values = sorted(v for v in columns[name] if v is not None)
        row, n = got[name], len(values)
        assert (row["non_null_count"], row["null_count"]) == (n, 3001 - n)
        for column, p in (("p25", "0.25"), ("median", "0.5"), ("p75", "0.75"), ("p95", "0.95")):
            rank = int((Decimal(p) * n).to_integral_value(ROUND_CEILING))
            assert row[column] == values[rank - 1]
        mean = math.fsum(values) / n
        assert math.isclose(row["avg_value"], mean, rel_tol=1e-9, abs_tol=1e-6)
        deviation = math.sqrt(math.fsum((v - mean) ** 2 for v in values) / n)
        assert math.isclose(row["stddev_value"], deviation, rel_tol=1e-9)
        assert (row["min_value"], row["max_value"]) == (values[0], values[-1])
    empty = got["empty"]
    assert (empty["non_null_count"], empty["null_count"]) == (0, 3001)
    assert empty["median"] is None and empty["avg_value"] is None and empty["stddev_value"] is None


def test_numeric_summary_of_no_rows(spark):
    df = spark.createDataFrame([], "x DOUBLE")
    row = profile.numeric_summary(df, ["x"]).first()
    assert (row["feature"], row["non_null_count"], row["null_count"], row["p25"]) == ("x", 0, 0, None)


def test_deviation_is_that_of_the_population(spark):
    df = spark.createDataFrame([(36.0,), (60.0,)], "x DOUBLE")
    assert profile.numeric_summary(df, ["x"]).first()["stddev_value"] == 12.0


def test_value_counts_show_null_and_sum_to_all_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "v STRING")
    rows = {r["value"]: (r["count"], r["share_pct"]) for r in profile.value_counts(df, ["v"]).collect()}
    assert rows == {"a": (2, 50.0), "NULL": (1, 25.0), "b": (1, 25.0)}


def test_catalogue_is_what_is_declared(spark):
    df = spark.range(1).select("id", F.lit(None).cast("string").alias("s"))
    rows = [tuple(r) for r in profile.column_catalogue(df).collect()]
    assert rows == [("id", "bigint", False), ("s", "string", True)]


def test_null_profile_of_an_empty_table(spark):
    row = profile.null_profile(spark.createDataFrame([], "x INT"), ["x"]).first()
    assert tuple(row) == ("x", 0, 0, None)


def test_distribution_covers_all_rows(loans):
    rows = profile.distribution(loans, PROFILE_BUCKETS).groupBy("feature").agg(F.sum("count").alias("n"))
    assert {r["n"] for r in rows.collect()} == {1500}


def parquet_loans(spark, loans, tmp_path):
    path = str(tmp_path / "loans")
    loans.write.parquet(path)
    return spark.read.parquet(path)


def test_reports_scan_once_and_only_what_they_need(spark, loans, tmp_path):
    stored = parquet_loans(spark, loans, tmp_path)
    for name, report in business.REPORTS.items():
        plan = final_plan(report(stored))
        assert plan.count("FileScan parquet") == 1, name
        assert "In(loan_status" in plan.split("PushedFilters")[1], name
    plan = final_plan(business.default_rate_by_grade(stored))
    assert "ReadSchema: struct<int_rate:double,grade:string,loan_status:string>" in plan


def test_profiles_scan_once(spark, loans, tmp_path):
    stored = parquet_loans(spark, loans, tmp_path)
    for name in (
        "dq_null_profile",
        "dq_loan_status_distribution",
        "dq_binary_target_distribution",
        "dq_categorical_value_counts",
        "dq_numeric_distributions",
    ):
        plan = final_plan(quality.REPORTS[name](stored))
        assert plan.count("FileScan parquet") == 1, (name, plan)


def test_dti_range_is_pushed_down(spark, loans, tmp_path):
    plan = final_plan(business.default_rate_by_dti(parquet_loans(spark, loans, tmp_path)))
    assert "GreaterThanOrEqual(dti,0.0)" in plan and "LessThanOrEqual(dti,100.0)" in plan
