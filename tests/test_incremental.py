"""Profiles of partitions that add up."""

from pyspark.sql import functions as F

from lendspark.constants import LOAN_COLUMNS, PROFILE_BUCKETS
from lendspark.operators import incremental, profile
from lendspark.sources import writers

CATEGORIES = ["grade", "home_ownership", "purpose"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def agree(spark, table, root, wanted):
    states = incremental.stored_states(spark, root)
    df = spark.table(table)
    assert rows(incremental.null_profile(states, wanted.columns)) == rows(profile.null_profile(df, wanted.columns))
    full = profile.value_counts(df, wanted.categories)
    assert rows(incremental.value_counts(states).select(*full.columns)) == rows(full)
    full = profile.distribution(df, wanted.buckets)
    assert rows(incremental.distribution(states).select(*full.columns)) == rows(full)


def test_only_changed_partitions_are_read_again(spark, loans, tmp_path, monkeypatch):
    table, path, root = "incremental_loans", str(tmp_path / "t"), str(tmp_path / "states")
    writers.write_curated(loans, table, path=path, buckets=2)
    wanted = incremental.Profile(LOAN_COLUMNS[:8], CATEGORIES, PROFILE_BUCKETS)
    scanned = []
    count = incremental.count_parts
    monkeypatch.setattr(incremental, "count_parts", lambda df, *a: scanned.append(len(df.inputFiles()) and df.select("grade").distinct().count()) or count(df, *a))
    fresh = lambda: spark.table(table)
    grades = sorted(r["grade"] for r in loans.select("grade").distinct().collect())
    assert sorted(incremental.refresh(fresh(), "grade", wanted, root)) == grades
    agree(spark, table, root, wanted)
    assert incremental.refresh(fresh(), "grade", wanted, root) == [] and len(scanned) == 1
    # One grade is replaced.
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        replaced = loans.where("grade = 'B'").limit(5).withColumn("purpose", F.lit("new"))
        replaced.select(*fresh().columns).write.mode("overwrite").format("parquet").insertInto(table, overwrite=True)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    spark.catalog.refreshTable(table)
    assert fresh().where("grade = 'B'").count() == 5
    assert incremental.refresh(fresh(), "grade", wanted, root) == ["B"]
    assert scanned == [len(grades), 1]
    agree(spark, table, root, wanted)
    # Another profile is counted from the start.
    other = incremental.Profile(LOAN_COLUMNS[:2], ["purpose"])
    assert sorted(incremental.refresh(fresh(), "grade", other, root)) == grades


def test_partitions_that_are_gone_or_have_no_value(spark, tmp_path):
    path, root = str(tmp_path / "t"), str(tmp_path / "s")
    df = spark.createDataFrame([(1, "A", "x"), (2, None, None), (3, "B", "y")], "id INT, p STRING, c STRING")
    wanted = incremental.Profile(["id", "c"], ["c"])
    read = lambda: spark.read.schema("id INT, c STRING, p STRING").parquet(path)
    df.write.partitionBy("p").parquet(path)
    assert set(incremental.refresh(read(), "p", wanted, root)) == {"A", None, "B"}
    df.where("p IS NULL OR p = 'B'").write.mode("overwrite").partitionBy("p").parquet(path)
    incremental.refresh(read(), "p", wanted, root)
    states = incremental.stored_states(spark, root)
    assert rows(incremental.null_profile(states, ["id", "c"])) == [("c", 1, 2, 50.0), ("id", 0, 2, 0.0)]
    assert {r["part"] for r in states.collect()} == {None, "B"}
