"""Session helpers: defaults for local work, and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "lendspark", **conf) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lendspark-warehouse-"),
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


COMPILED_BYTES = "spark.sql.codegen.hugeMethodLimit"


def compile_wide_rows(spark: SparkSession) -> None:
    """Have what Spark generates for rows of many fields compiled by the JVM.

    The JVM interprets any method of more than 8000 bytes for good. With this limit Spark
    runs such a stage in smaller methods. A limit that the session was given stands.
    """
    if int(spark.conf.get(COMPILED_BYTES)) > 8000 and not spark.sparkContext.getConf().contains(COMPILED_BYTES):
        spark.conf.set(COMPILED_BYTES, "8000")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of this cluster.

    Read from ``spark.checkpoint.dir`` (or from a directory set on the context). A local
    session with neither, such as a test, gets a temporary folder; on a cluster each
    executor would see another one, so there that is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    active = context.getCheckpointDir()
    if configured:
        if active is None:
            context.setCheckpointDir(configured)
        return configured
    if active is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="lendspark-checkpoint-"))
        active = context.getCheckpointDir()
    return active


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system that Spark reaches."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def work_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A path in the shared folder that is gone afterwards, also after an error."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        remove(spark, path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, never handed out twice."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
