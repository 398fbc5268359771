from pathlib import Path
from unittest.mock import Mock

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lendspark.constants import LOAN_COLUMNS, LOAN_SCHEMA
from lendspark.operators.validation import ConstraintViolation
from lendspark.plans import business
from lendspark.plans.ingest import ingest
from lendspark.plans.reporting import publish_reports
from lendspark.session import checkpoint_root, scratch_path, work_folder
from lendspark.sources import catalog, readers, writers


def header(columns):
    return ",".join(columns)


def test_raw_csv_projects_in_order_and_ignores_extras(spark, tmp_path):
    file = tmp_path / "raw.csv"
    file.write_text("extra, b ,a\nx,2,1\ny,,\n")
    rows = [tuple(r) for r in readers.read_raw_csv(spark, str(file), ["a", "b"]).collect()]
    assert rows == [("1", "2"), (None, None)]


def test_missing_headers_are_listed_in_order(spark, tmp_path):
    file = tmp_path / "raw.csv"
    file.write_text("b\n1\n")
    with pytest.raises(ValueError, match="The header lacks: a, c$"):
        readers.read_raw_csv(spark, str(file), ["c", "b", "a"])


def test_quotes_line_breaks_and_bad_bytes(spark, tmp_path):
    file = tmp_path / "raw.csv"
    file.write_bytes(b'a,b\n"say ""hi"", twice",1\n"two\nlines",2\nbad\xff,3\n')
    rows = readers.read_raw_csv(spark, str(file), ["a", "b"], multi_line=True).collect()
    assert [tuple(r) for r in rows] == [
        ('say "hi", twice', "1"),
        ("two\nlines", "2"),
        ("bad�", "3"),
    ]


def test_typed_csv_rejects_wrong_types(spark, tmp_path):
    file = tmp_path / "typed.csv"
    file.write_text("a,b\n1,x\n,y\n")
    loaded = readers.load_typed_csv(spark, str(file), "a INT, b STRING")
    assert [tuple(r) for r in loaded.collect()] == [(1, "x"), (None, "y")]
    file.write_text("a,b\none,x\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.load_typed_csv(spark, str(file), "a INT, b STRING").collect()


def test_read_source_by_name_and_by_path(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.save_table(spark.range(3), "source_table", path=path)
    assert readers.read_source(spark, "source_table").count() == 3
    assert readers.read_source(spark, path).count() == 3
    assert readers.read_source(spark, f"file:{path}").count() == 3


def test_large_snapshots_get_more_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "RANGE_ROWS", 100)
    path = str(tmp_path / "large")
    writers.snapshot(spark.range(1000).repartition(7), path, splits=4)
    assert len(list(Path(path).glob("*.parquet"))) == 10
    assert spark.read.parquet(path).count() == 1000


def test_snapshot_writes_ranges(spark, tmp_path):
    path = str(tmp_path / "s")
    writers.snapshot(spark.range(1000).repartition(7), path, splits=4)
    files = list(Path(path).glob("*.snappy.parquet"))
    assert len(files) == 4
    bounds = sorted(
        (r["lo"], r["hi"])
        for r in spark.read.parquet(path)
        .groupBy(F.input_file_name())
        .agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
        .collect()
    )
    assert all(hi < lo for (_, hi), (lo, _) in zip(bounds, bounds[1:]))


def test_second_run_adds_nothing(spark, loans, tmp_path):
    for _ in range(2):
        writers.write_curated(loans, "curated_twice", path=str(tmp_path / "c"))
        writers.publish(loans.limit(5), "published_twice", path=str(tmp_path / "p"))
    assert spark.table("curated_twice").count() == 1500
    assert spark.table("published_twice").count() == 5


def test_curated_table_prunes_and_joins_without_shuffle(spark, loans, tmp_path):
    writers.write_curated(loans, "curated_plan", path=str(tmp_path / "c"))
    table = spark.table("curated_plan")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(grade" in plan(table.where("grade = 'A'"))
    # Each bucket of a partition is one file.
    assert len(list(Path(tmp_path / "c").glob("grade=*/*.parquet"))) == 7 * 8
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = table.join(table.select("id", F.col("dti").alias("other")), "id")
        assert "Exchange" not in plan(joined)
        assert joined.count() == 1500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_small_export_is_one_file(spark, tmp_path):
    df = spark.range(50).repartition(8)
    writers.export_csv(df, str(tmp_path / "plain"))
    writers.export_csv(df, str(tmp_path / "sorted"), order_by=["id"])
    for name in ("plain", "sorted"):
        (file,) = (tmp_path / name).glob("*.csv")
        lines = file.read_text().splitlines()
        assert lines[0] == "id" and len(lines) == 51
    assert lines[1:] == [str(i) for i in range(50)]


def test_typed_round_trip(spark, loans, tmp_path):
    path = str(tmp_path / "csv")
    writers.export_csv(loans, path)
    again = readers.load_typed_csv(spark, path, LOAN_SCHEMA)
    assert again.exceptAll(loans).count() == 0 and loans.exceptAll(again).count() == 0
    assert again.columns == LOAN_COLUMNS


def test_summary_text_with_commas_and_quotes_stays_whole(spark, tmp_path):
    text = 'a__thresholds=[1.0, 2.0]; b="x"'
    row = ("NaiveBayes", *[0.5] * 6, 1, 2, 3, 4, text)
    names = "model accuracy precision recall f1 areaUnderROC areaUnderPR tp tn fp fn best_params"
    evaluation = spark.createDataFrame([row], names.split())
    catalog.publish_dashboard({"evaluation": evaluation}, str(tmp_path))
    tables = catalog.register_summaries(spark, str(tmp_path), prefix="whole_")
    assert tuple(spark.table(tables["evaluation"]).first()) == row


def test_unknown_summary_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="Not a summary table: other"):
        catalog.publish_dashboard({"other": spark.range(1)}, str(tmp_path))


def test_statistics(spark, tmp_path):
    writers.save_table(spark.range(123), "with_stats", path=str(tmp_path / "t"))
    catalog.analyze(spark, "with_stats", columns=True)
    counted = catalog.table_statistics(spark, "with_stats")
    assert counted["rows"] == 123 and counted["bytes"] > 0


def test_scratch_paths_are_fresh_and_in_the_shared_folder(spark):
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two and one.startswith(checkpoint_root(spark).rstrip("/"))


def test_configured_shared_folder_is_used():
    session = Mock()
    session.conf.get.return_value = "hdfs://shared/checkpoints"
    assert scratch_path(session, "x").startswith("hdfs://shared/checkpoints/x-")


def test_a_cluster_needs_a_shared_folder():
    session = Mock()
    session.conf.get.return_value = None
    session.sparkContext.getCheckpointDir.return_value = None
    session.sparkContext.master = "spark://host:7077"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session, "x")


def test_work_folder_is_removed_also_after_an_error(spark):
    with pytest.raises(RuntimeError):
        with work_folder(spark, "w") as path:
            spark.range(3).write.parquet(path)
            raise RuntimeError
    assert not Path(path.removeprefix("file:")).exists()


def test_split_reading_fails_on_records_over_several_lines(spark, tmp_path):
    file = tmp_path / "raw.csv"
    file.write_text('a,b\n1,"two\nlines"\n')
    rows = readers.read_raw_csv(spark, str(file), ["a", "b"]).collect()
    assert [tuple(r) for r in rows] == [("1", "two\nlines")]
    with pytest.raises((PySparkException, Py4JJavaError), match="Not a whole record"):
        readers.read_raw_csv(spark, str(file), ["a"], multi_line=False).collect()
    file.write_text("a,b\n1,2\n3,\n")
    rows = readers.read_raw_csv(spark, str(file), ["b"], multi_line=False).collect()
    assert [r["b"] for r in rows] == ["2", None]


def test_typed_csv_checks_columns_that_nobody_reads(spark, tmp_path):
    file = tmp_path / "typed.csv"
    file.write_text("a,b\n1,x\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.load_typed_csv(spark, str(file), "a INT, b INT").select("a").count()
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.load_typed_csv(spark, str(file), "b STRING, a INT").collect()


def test_folder_with_a_quote_in_its_name(spark, tmp_path):
    root = str(tmp_path / "it's")
    split = spark.createDataFrame([("d", 1, 2)], "dataset STRING, rows BIGINT, feature_count INT")
    catalog.publish_dashboard({"split_summary": split}, root)
    tables = catalog.register_summaries(spark, root, prefix="quoted_", names=["split_summary"])
    assert set(tables) == {"split_summary"}
    assert tuple(spark.table(tables["split_summary"]).first()) == ("d", 1, 2)


def test_exports_are_sorted(spark, loans, tmp_path):
    tables = publish_reports(loans, str(tmp_path), "sorted_", {"q1": business.REPORTS["q1"]})
    (file,) = (tmp_path / "export" / "q1").glob("*.csv")
    grades = [line.split(",")[0] for line in file.read_text().splitlines()[1:]]
    assert grades == sorted(grades) and len(grades) == 7
    assert spark.table(tables["q1"]).count() == 7


def test_ingest_refuses_repeated_keys_before_it_writes(spark, tmp_path):
    schema = ", ".join(f"{name} STRING" for name in LOAN_COLUMNS)
    rows = [tuple("7" if name == "id" else None for name in LOAN_COLUMNS)] * 2
    with pytest.raises(ConstraintViolation):
        ingest(spark.createDataFrame(rows, schema), "refused", str(tmp_path / "r"), str(tmp_path / "c"))
    assert not (tmp_path / "r").exists() and not (tmp_path / "c").exists()
