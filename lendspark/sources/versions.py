"""Publishing that is all or nothing: write aside, audit, then change one pointer.

A table is published as a view over its latest version. A version is a table of its own, at
a place of its own; it is written and checked under its own name, and only then the view is
replaced, which is one change in the catalog. Whoever reads the name sees the old version or
the new one, never a part, and a failed write or audit leaves the old one as it was.

A package of folders has a numbered manifest per publication, which names the folder of its
version. The manifest is put in place by a rename after all folders are complete, and
readers take the highest number. There is one publisher at a time; earlier versions stay for
those who are still reading them, as many as asked for.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.constants import LOAN_RULES
from lendspark.operators.validation import enforce
from lendspark.session import remove
from lendspark.sources.names import quoted
from lendspark.sources.writers import write_curated

MARK = "__v"
MANIFESTS = "_manifests"


def _fresh() -> str:
    """Names that sort by time and never meet."""
    return f"{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"


def table_versions(spark: SparkSession, table: str) -> list[str]:
    """The versions of ``table`` that the catalog holds, oldest first."""
    database, _, name = table.rpartition(".")
    found = spark.catalog.listTables(database or None)
    prefix = f"{database}." if database else ""
    return sorted(prefix + t.name for t in found if t.name.lower().startswith(f"{name}{MARK}".lower()))


def _drop(spark: SparkSession, version: str, root: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quoted(version)}")
    remove(spark, f"{root}/{version.rpartition('.')[2]}")


def _is_table(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW"


def publish_table(
    spark: SparkSession,
    table: str,
    root: str,
    write: Callable[[str, str], None],
    audit: Callable[[DataFrame], object] = lambda staged: None,
    keep: int = 2,
) -> str:
    """Write, audit and publish a version of ``table``; returns the version's name.

    ``write`` gets the name and the path of the version; ``audit`` gets the written table
    and raises if it must not be published. Then nothing changes, and the version is
    removed again. The last ``keep`` versions stay. A plain table of that name becomes the
    first version.
    """
    version = f"{table}{MARK}{_fresh()}"
    path = f"{root}/{version.rpartition('.')[2]}"
    try:
        write(version, path)
        audit(spark.table(version))
    except BaseException:
        _drop(spark, version, root)
        raise
    earlier = None
    if _is_table(spark, table):
        earlier = f"{table}{MARK}{0:020d}"
        spark.sql(f"ALTER TABLE {quoted(table)} RENAME TO {quoted(earlier)}")
    try:
        spark.sql(f"CREATE OR REPLACE VIEW {quoted(table)} AS SELECT * FROM {quoted(version)}")
    except BaseException:
        if earlier:
            spark.sql(f"ALTER TABLE {quoted(earlier)} RENAME TO {quoted(table)}")
        raise
    for old in table_versions(spark, table)[: -max(1, keep)]:
        _drop(spark, old, root)
    return version


def publish_curated(
    df: DataFrame,
    table: str,
    root: str,
    rules: Mapping[str, str] = LOAN_RULES,
    key: str | None = "id",
    keep: int = 2,
    **layout,
) -> str:
    """The curated table as a new version that keeps all ``rules`` and whose ``key`` is unique.

    ``layout`` is that of :func:`lendspark.sources.writers.write_curated`.
    """
    return publish_table(
        df.sparkSession,
        table,
        root,
        lambda name, path: write_curated(df, name, path=path, **layout),
        lambda staged: enforce(staged, rules, key),
        keep,
    )


def _files(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(str(status.getPath()) for status in system.globStatus(path) or [])


def _put(spark: SparkSession, path: str, content: str) -> None:
    """A file that is not there until it is complete."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    aside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = system.create(aside, False)
    stream.write(bytearray(content.encode()))
    stream.close()
    if system.exists(target) or not system.rename(aside, target):
        system.delete(aside, False)
        raise FileExistsError(path)


def manifests(spark: SparkSession, root: str) -> list[dict]:
    """The publications of a package, oldest first."""
    found = _files(spark, f"{root}/{MANIFESTS}/*.json")
    if not found:
        return []
    rows = spark.read.text(found, wholetext=True).select("value", F.col("_metadata.file_name").alias("file")).collect()
    return [json.loads(row["value"]) for row in sorted(rows, key=lambda row: row["file"])]


def publish_package(
    spark: SparkSession, root: str, writes: Mapping[str, Callable[[str], None]], keep: int = 2
) -> dict:
    """Write all folders of a package aside and make them its current ones together.

    ``writes`` has, per folder, what writes it to a path. If one fails, readers go on with
    the publication before. Returns the manifest.
    """
    before = manifests(spark, root)
    manifest = {
        "number": before[-1]["number"] + 1 if before else 1,
        "folder": f"version_{_fresh()}",
        "names": list(writes),
    }
    try:
        for name, write in writes.items():
            write(f"{root}/{manifest['folder']}/{name}")
        _put(spark, f"{root}/{MANIFESTS}/{manifest['number']:010d}.json", json.dumps(manifest))
    except BaseException:
        remove(spark, f"{root}/{manifest['folder']}")
        raise
    for old in before[: max(0, len(before) + 1 - max(1, keep))]:
        remove(spark, f"{root}/{MANIFESTS}/{old['number']:010d}.json")
        remove(spark, f"{root}/{old['folder']}")
    return manifest


def current_package(spark: SparkSession, root: str) -> str:
    """The folder of the latest publication, or ``root`` itself if there was none."""
    found = manifests(spark, root)
    return f"{root}/{found[-1]['folder']}" if found else root
