"""Exact deduplication of whole texts.

Method: Grace hash deduplication. A task streams its records through an open-addressing
table that compares complete contents. If the distinct contents outgrow the memory
allowed, table and stream are partitioned by further bits of the hash into spill files,
and each file is treated in the same way, until a bucket fits. Every task first merges
the copies among its own rows, so however large a group is, one record per task goes
through the shuffle; the merged records then meet by hash and are merged again.

Defined cases: a NULL text is an empty one. Of equal texts the record with the largest
id stays, NULL being the smallest; of records that tie on both, one stays, whichever.
No rows give no rows.
"""

from __future__ import annotations

import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lendspark.llm.common import in_arrow

FANOUT_BITS = 4
HASH_BITS = 64
WRITE_ROWS = 256
OUT_BYTES = 8 << 20

# Records are lists; these are the places of what merging reads.
HASH, CONTENT, SIZE, ID = range(4)


class ContentTable:
    """Open addressing with linear probing; one record per distinct content."""

    def __init__(self):
        self.mask = 1023
        self.slots = [-1] * (self.mask + 1)
        self.records: list[list] = []
        self.bytes = 0

    def add(self, record: list) -> None:
        """Take in a record, or merge it with that of the same content."""
        slots, records, mask = self.slots, self.records, self.mask
        at = record[HASH] & mask
        while (place := slots[at]) >= 0:
            present = records[place]
            if present[HASH] == record[HASH] and present[CONTENT] == record[CONTENT]:
                records[place] = merged(present, record)
                return
            at = (at + 1) & mask
        slots[at] = len(records)
        records.append(record)
        self.bytes += len(record[CONTENT]) + 400
        if len(records) * 2 > mask:
            self._grow()

    def _grow(self) -> None:
        self.mask = mask = self.mask * 4 + 3
        self.slots = slots = [-1] * (mask + 1)
        for place, record in enumerate(self.records):
            at = record[HASH] & mask
            while slots[at] >= 0:
                at = (at + 1) & mask
            slots[at] = place


def merged(one: list, two: list) -> list:
    """The record that stays of two with the same content, with the size of both."""
    size = one[SIZE] + two[SIZE]
    later = one[ID] is None or (two[ID] is not None and two[ID] > one[ID])
    stays = two if later else one
    stays[SIZE] = size
    return stays


class Spill:
    """Records in one file per value of some bits of the hash."""

    def __init__(self, folder: str, level: int):
        self.shift = HASH_BITS - FANOUT_BITS * (level + 1)
        self.paths = [os.path.join(folder, f"{level}-{k}") for k in range(1 << FANOUT_BITS)]
        self.files = [open(path, "wb") for path in self.paths]
        self.waiting: list[list] = [[] for _ in self.paths]

    def add(self, record: list) -> None:
        bucket = (record[HASH] >> self.shift) & ((1 << FANOUT_BITS) - 1)
        self.waiting[bucket].append(record)
        if len(self.waiting[bucket]) >= WRITE_ROWS:
            self._write(bucket)

    def _write(self, bucket: int) -> None:
        pickle.dump(self.waiting[bucket], self.files[bucket], pickle.HIGHEST_PROTOCOL)
        self.waiting[bucket] = []

    def finish(self) -> list[str]:
        for bucket, file in enumerate(self.files):
            self._write(bucket)
            file.close()
        return self.paths


def _read(path: str) -> Iterator[list]:
    with open(path, "rb") as file:
        while True:
            try:
                rows = pickle.load(file)
            except EOFError:
                return
            yield from rows


def distinct(records: Iterable[list], memory: int, level: int = 0) -> Iterator[list]:
    """One record per content, holding about ``memory`` bytes of them at a time."""
    table, stream = ContentTable(), iter(records)
    last = FANOUT_BITS * (level + 1) >= HASH_BITS  # no bits left: one hash, kept together
    for record in stream:
        table.add(record)
        if table.bytes > memory and not last:
            break
    else:
        yield from table.records
        return
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        spill = Spill(folder, level)
        for record in table.records:
            spill.add(record)
        del table
        for record in stream:
            spill.add(record)
        for path in spill.finish():
            yield from distinct(_read(path), memory, level + 1)
            os.remove(path)


def _merge(df: DataFrame, memory: int) -> DataFrame:
    schema = to_arrow_schema(df.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for batch in batches:
                for at in range(0, batch.num_rows, WRITE_ROWS):
                    columns = [c.to_pylist() for c in batch.slice(at, WRITE_ROWS).columns]
                    yield from map(list, zip(*columns))

        def batch_of(rows):
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)]
            return pa.record_batch(columns, schema)

        rows, size = [], 0
        for record in distinct(records(), memory):
            rows.append(record)
            size += len(record[CONTENT]) + 100
            if size > OUT_BYTES:
                yield batch_of(rows)
                rows, size = [], 0
        if rows:
            yield batch_of(rows)

    return in_arrow(df, run, df.schema)


def deduplicate(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", memory: int = 48 << 20
) -> DataFrame:
    """The rows that stay, in a struct column ``row`` with the columns of ``df``.

    Next to it ``content`` and ``group_size``. ``memory`` bounds the contents that a task
    holds.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    inputs = [F.col(f"`{name}`").alias(f"in_{n}") for n, name in enumerate(df.columns) if name != text]
    records = df.select(
        F.xxhash64(content).alias("_hash"),
        content.alias("_content"),
        F.lit(1).cast("bigint").alias("_size"),
        F.col(doc_id).alias("_id"),
        F.col(text).isNull().alias("_missing"),
        *inputs,
    )
    merged_once = _merge(records, memory)
    merged_all = _merge(merged_once.repartition("_hash"), memory)
    back = [
        F.when(~F.col("_missing"), F.col("_content")).alias(name)
        if name == text
        else F.col(f"in_{n}").alias(name)
        for n, name in enumerate(df.columns)
    ]
    return merged_all.select(
        F.struct(*back).alias("row"),
        F.col("_content").alias("content"),
        F.col("_size").alias("group_size"),
    )


def keep_one(df: DataFrame, **settings) -> DataFrame:
    """One row of ``df`` per distinct text."""
    return deduplicate(df, **settings).select("row.*")


def groups(df: DataFrame, text: str = "text", doc_id: str = "doc_id", **settings) -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and
    ``text_sha256``.

    Rows that agree in text and id are counted before they meet their group.
    """
    narrow = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    digest = lambda content: F.sha2(content, 256).alias("text_sha256")
    stays = deduplicate(narrow, **settings).select(
        digest(F.col("content")), F.col("row.doc_id").alias("keep_id"), "group_size"
    )
    rows = (
        narrow.select("doc_id", digest(F.coalesce("text", F.lit(""))))
        .groupBy("doc_id", "text_sha256")
        .agg(F.count("*").alias("_times"))
    )
    return (
        rows.join(stays, "text_sha256")
        .withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_nth") == 1)).alias("kept"),
            "text_sha256",
        )
    )
