"""What several of the corpus operators need."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.session import scratch_path

# Words are what lies between these six characters.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
# Tasks that read less leave too little behind to look for it.
LARGE_TASK_BYTES = 4 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read again.

    Cuts the lineage: a lost executor costs later steps a re-read, and every reader
    sees the same rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """As :func:`stored`, as a table in buckets of ``key``; joins by it leave it where it lies."""
    spark, unique = df.sparkSession, f"{name}_{uuid4().hex}"
    df.write.bucketBy(partitions(df), key).option("path", scratch_path(spark, name)).saveAsTable(unique)
    return spark.table(unique)


def _hand_back() -> None:
    """Give the system what this process freed; else its allocators keep it for later."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def in_arrow(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema
) -> DataFrame:
    """``df.mapInArrow``, where large tasks hand back the memory they freed.

    Python workers go on living beside the JVM, whose later stages need that memory too.
    """

    def handing_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 0

        def counted() -> Iterator[pa.RecordBatch]:
            nonlocal size
            for batch in batches:
                size += batch.nbytes
                yield batch

        yield from run(counted())
        if size >= LARGE_TASK_BYTES:
            _hand_back()

    return df.mapInArrow(handing_back, schema)


def without(text: Column, characters: str) -> Column:
    """``text`` with every one of ``characters`` taken out."""
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK_RUN), "")


def content_key(text: Column) -> list[Column]:
    """128 bits that stand for a text, as two integers."""
    return [F.xxhash64(text), F.xxhash64(F.lit("second"), text)]


def partitions(df: DataFrame) -> int:
    """Tasks a shuffle of this session gets."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
