"""Publishing that is all or nothing."""

from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lendspark.operators.validation import ConstraintViolation
from lendspark.sources import catalog, versions, writers

RULES = {"positive": "n > 0"}


def rows(spark, *numbers):
    return spark.createDataFrame([(i, n, "A") for i, n in enumerate(numbers)], "id BIGINT, n INT, grade STRING")


def numbers(spark, table):
    return sorted(r["n"] for r in spark.table(table).collect())


def test_a_failed_write_or_audit_leaves_the_old_table(spark, tmp_path):
    publish = lambda df, **more: versions.publish_curated(df, "wap_loans", str(tmp_path), RULES, buckets=2, **more)
    first = publish(rows(spark, 1, 2, 3))
    assert numbers(spark, "wap_loans") == [1, 2, 3]
    # One task fails after others have written.
    broken = F.when(F.col("n") == 9, F.raise_error(F.lit("midway")).cast("int")).otherwise(F.col("n"))
    with pytest.raises((PySparkException, Py4JJavaError), match="midway"):
        publish(rows(spark, 5, 6, 9).repartition(3).withColumn("n", broken))
    with pytest.raises(ConstraintViolation) as error:
        publish(rows(spark, 4, -1))
    assert error.value.counts == {"positive": 1}
    with pytest.raises(ConstraintViolation):
        publish(rows(spark, 4, 5).withColumn("id", F.lit(7)))
    assert numbers(spark, "wap_loans") == [1, 2, 3]
    assert versions.table_versions(spark, "wap_loans") == [first]
    assert [p.name for p in tmp_path.iterdir()] == [first]
    second = publish(rows(spark, 7, 8))
    assert numbers(spark, "wap_loans") == [7, 8] and numbers(spark, first) == [1, 2, 3]
    third = publish(rows(spark, 1))
    assert versions.table_versions(spark, "wap_loans") == [second, third]
    assert sorted(p.name for p in tmp_path.iterdir()) == [second, third]


def test_a_published_table_is_pruned_by_partition(spark, tmp_path):
    df = spark.range(400).select("id", (F.col("id") + 1).cast("int").alias("n"), F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("grade"))
    versions.publish_curated(df, "wap_pruned", str(tmp_path), RULES, buckets=4)
    wanted = spark.table("wap_pruned").where("grade = 'A' AND id = 8")
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(grade" in plan and "PushedFilters: [IsNotNull(id), EqualTo(id,8)]" in plan
    assert wanted.count() == 1


def test_a_plain_table_becomes_the_first_version(spark, tmp_path):
    writers.save_table(rows(spark, 1), "wap_plain", path=str(tmp_path / "plain"))
    versions.publish_curated(rows(spark, 2), "wap_plain", str(tmp_path), RULES)
    assert numbers(spark, "wap_plain") == [2]
    first, _ = versions.table_versions(spark, "wap_plain")
    assert numbers(spark, first) == [1]


def split_summary(spark, count):
    return spark.createDataFrame([("d", count, 2)], "dataset STRING, rows BIGINT, feature_count INT")


def distribution(spark, count):
    return spark.createDataFrame([("d", 0.0, count, 1.0)], "dataset STRING, label DOUBLE, count BIGINT, share DOUBLE")


def test_a_package_changes_as_a_whole(spark, tmp_path):
    root = str(tmp_path)
    names = ["split_summary", "label_distribution"]

    def seen(prefix):
        tables = catalog.register_summaries(spark, root, prefix=prefix, names=names)
        return [spark.table(tables["split_summary"]).first()["rows"], spark.table(tables["label_distribution"]).first()["count"]]

    both = lambda n: {"split_summary": split_summary(spark, n), "label_distribution": distribution(spark, n)}
    catalog.publish_dashboard(both(1), root)
    assert seen("one_") == [1, 1]
    failing = both(2) | {"label_distribution": distribution(spark, 2).withColumn("count", F.raise_error(F.lit("stop")).cast("bigint"))}
    with pytest.raises((PySparkException, Py4JJavaError), match="stop"):
        catalog.publish_dashboard(failing, root)
    assert seen("two_") == [1, 1]
    # Between the folders and the manifest, readers still see the old package.
    during = []
    put = versions._put
    versions._put = lambda *a: (during.append(seen("three_")), put(*a))
    try:
        catalog.publish_dashboard(both(3), root)
    finally:
        versions._put = put
    assert during == [[1, 1]] and seen("four_") == [3, 3]
    # Who registered the old package still reads it whole, until it is one too many.
    assert spark.table("default.one_split_summary").first()["rows"] == 1
    catalog.publish_dashboard(both(4), root)
    assert seen("five_") == [4, 4] and len(versions.manifests(spark, root)) == 2
    assert len([p for p in Path(root).iterdir() if p.name.startswith("version_")]) == 2


def test_manifests_are_never_replaced(spark, tmp_path):
    versions._put(spark, f"{tmp_path}/m.json", "{}")
    with pytest.raises(FileExistsError):
        versions._put(spark, f"{tmp_path}/m.json", "[]")
    assert (tmp_path / "m.json").read_text() == "{}" and versions.current_package(spark, str(tmp_path)) == str(tmp_path)
