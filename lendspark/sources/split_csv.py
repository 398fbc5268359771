"""One large quoted CSV file read by many tasks.

A line break may stand within quotes, so where a record begins is only known from all that
comes before. Files are split into byte ranges at line breaks, as any text file is, and a
first pass over the lines that hold a quote works out for each split how it ends if it
begins outside of quotes and how if it begins within. A prefix scan over one row per split
says which of the two is true. A second pass puts the lines of each split together to
records; what a split has of a record that began before, or goes on after it, is joined with
its other parts afterwards. Spark's own CSV parser then takes the records apart.

Without a quoted line break in any file, which the first pass finds, every line is a record
and Spark reads the splits by itself.

Records end at a line feed, with or without a carriage return before it. Quotes are doubled
within quotes, and a quote within an unquoted field is a character like any other.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.session import scratch_path

OPTIONS = {"encoding": "UTF-8", "quote": '"', "escape": '"'}

# A field in quotes, after its opening one; whether its end is in the line decides.
_CLOSED = r'(?:[^"]|"")*"(?:[^",][^,]*)?'
_FIELDS = rf'(?:,(?:"{_CLOSED}|[^",][^,]*|))*'
_OPEN = r',"(?:[^"]|"")*$'
#: A line that begins outside of quotes and ends within.
ENDS_OPEN = rf'^"(?:[^"]|"")*$|^(?:"{_CLOSED}|[^",][^,]*|){_FIELDS}{_OPEN}'
#: A line that begins within quotes and ends within: the same ones, or others.
STAYS_OPEN = rf'^(?:[^"]|"")*$|^{_CLOSED}{_FIELDS}{_OPEN}'

SPLIT = ["file", "split"]
STEPS = "file BIGINT, split BIGINT, opens BOOLEAN, after_outside BOOLEAN, closes BOOLEAN, after_within BOOLEAN"
STATES = "file BIGINT, split BIGINT, begins_within BOOLEAN, ends_within BOOLEAN, opener BIGINT"
PIECES = "file BIGINT, split BIGINT, opener BIGINT, whole BOOLEAN, head BOOLEAN, record BINARY"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, split, line`` of every line, in order within a task."""
    text = spark.read.text(path, lineSep="\n")
    return text.select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("line"),
    )


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, int]]:
    """``(file, split, first, end)`` of the rows of each split in turn."""
    file, split = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    change = np.flatnonzero((np.diff(file) != 0) | (np.diff(split) != 0)) + 1
    for first, end in zip([0, *change], [*change, batch.num_rows]):
        if end > first:
            yield int(file[first]), int(split[first]), int(first), int(end)


def _turns(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per line, whether it ends within quotes if it begins outside, and if within."""
    quoted = np.asarray(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False), bool)
    opens, stays = np.zeros(len(lines), bool), np.ones(len(lines), bool)
    at = np.flatnonzero(quoted)
    if len(at):
        some = lines.take(pa.array(at))
        opens[at] = pc.match_substring_regex(some, ENDS_OPEN).to_numpy(zero_copy_only=False)
        stays[at] = pc.match_substring_regex(some, STAYS_OPEN).to_numpy(zero_copy_only=False)
    return opens, stays


def _after(within: bool, opens: np.ndarray, stays: np.ndarray) -> np.ndarray:
    """Per line, whether it ends within quotes, if the first begins so or not."""
    # Some lines end the same way from either beginning; those after only keep or turn that.
    settled = np.maximum.accumulate(np.where(opens == stays, np.arange(len(opens)), -1))
    turned = np.cumsum(opens & ~stays)
    known = settled >= 0
    base = np.where(known, opens[settled], within)
    return base ^ ((turned - np.where(known, turned[settled], 0)) % 2 == 1)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per split: how it ends, from either beginning."""
    rows: dict[tuple[int, int], list[bool]] = {}
    for batch in batches:
        for file, split, first, end in _stretches(batch):
            state = rows.setdefault((file, split), [False, False, False, True])
            opens, stays = _turns(batch.column(2).slice(first, end - first))
            for k, start in ((0, state[1]), (2, state[3])):
                after = _after(start, opens, stays)
                state[k + 1] = bool(after[-1])
                state[k] = state[k] or bool((after != start).any())
    keys = list(rows)
    columns = [*zip(*keys), *zip(*rows.values())] if keys else [[]] * 6
    kinds = [pa.int64()] * 2 + [pa.bool_()] * 4
    yield pa.record_batch(
        [pa.array(column, kind) for column, kind in zip(columns, kinds)],
        names=["file", "split", "opens", "after_outside", "closes", "after_within"],
    )


def _scan(rows: pd.DataFrame) -> pd.DataFrame:
    """The true state at both ends of each split of one file.

    ``opener`` is the split in which the record that is open at the end began.
    """
    rows = rows.sort_values("split")
    within, opener, out = False, -1, []
    for row in rows.itertuples():
        begins = within
        if begins:
            within, renewed = row.after_within, row.closes
        else:
            within, renewed = row.after_outside, True
        before = opener
        if within and renewed:
            opener = row.split
        elif not within:
            opener = -1
        out.append((row.file, row.split, begins, within, before))
    return pd.DataFrame(out, columns=["file", "split", "begins_within", "ends_within", "opener"])


class _Assembly:
    """The records of one split, put together from its lines."""

    def __init__(self, file: int, split: int, within: bool, opener: int):
        self.key, self.within, self.opener = (file, split), within, opener
        self.head_due = split == 0
        #: Lines of a record that is not complete yet.
        self.held: list[pa.Array] = []

    def pieces(self, records: pa.Array, complete: bool) -> pa.RecordBatch:
        """Records, of which the first may be a part of one that began before."""
        file, split = self.key
        opener, whole = np.full(len(records), split), np.full(len(records), complete)
        if self.opener >= 0:
            opener[0], whole[0], self.opener = self.opener, False, -1
        # Lines between records that are empty are none.
        length = pc.binary_length(records)
        empty = pc.or_(pc.equal(length, 0), pc.equal(records, pa.scalar(b"\r", pa.binary())))
        kept = ~whole | ~np.asarray(empty.to_numpy(zero_copy_only=False), bool)
        head = np.zeros(len(records), bool)
        if self.head_due and kept.any():
            head[kept.argmax()], self.head_due = True, False
        n = int(kept.sum())
        return pa.record_batch(
            [
                pa.array(np.full(n, file)),
                pa.array(np.full(n, split)),
                pa.array(opener[kept]),
                pa.array(whole[kept]),
                pa.array(head[kept]),
                records.filter(pa.array(kept)),
            ],
            names=["file", "split", "opener", "whole", "head", "record"],
        )

    def take(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        after = _after(self.within, *_turns(lines))
        self.within = bool(after[-1])
        ends = np.flatnonzero(~after) + 1
        if len(ends):
            before, last = sum(map(len, self.held)), int(ends[-1])
            offsets = np.concatenate([[0], before + ends]).astype(np.int32)
            yield self.pieces(_joined([*self.held, lines.slice(0, last)], offsets), complete=True)
            self.held, lines = [], lines.slice(last)
        if len(lines):
            self.held.append(lines)

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            offsets = np.array([0, sum(map(len, self.held))], np.int32)
            yield self.pieces(_joined(self.held, offsets), complete=False)


def _joined(lines: list[pa.Array], offsets: np.ndarray) -> pa.Array:
    """One record from the lines between each two offsets."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), pa.concat_arrays(lines)), b"\n")


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and parts of records, from lines with the state that their split begins in."""
    current = None
    for batch in batches:
        for file, split, first, end in _stretches(batch):
            if current is None or current.key != (file, split):
                if current is not None:
                    yield from current.end()
                within = bool(batch.column(3)[first].as_py())
                current = _Assembly(file, split, within, batch.column(4)[first].as_py() if within else -1)
            yield from current.take(batch.column(2).slice(first, end - first))
    if current is not None:
        yield from current.end()


def _records(lines: DataFrame, states: DataFrame) -> DataFrame:
    """``head, record`` of every record of the files."""

    def pieces(some: DataFrame, where: DataFrame, how: str) -> DataFrame:
        # One row per split, of which a file has one for each 128 MB as a rule.
        placed = some.join(F.broadcast(where), SPLIT, how).select(
            *SPLIT,
            "line",
            F.coalesce("begins_within", F.lit(False)).alias("begins_within"),
            F.coalesce("opener", F.lit(-1)).cast("bigint").alias("opener"),
        )
        return placed.mapInArrow(_assemble, PIECES)

    whole = pieces(lines, states, "left").where("whole").select("head", "record")
    cut = states.where("begins_within OR ends_within")
    if cut.isEmpty():
        return whole
    parts = (
        pieces(lines, cut, "inner")
        .where("NOT whole")
        .groupBy("file", "opener")
        .agg(
            F.max("head").alias("head"),
            F.array_sort(F.collect_list(F.struct("split", F.col("record").cast("string").alias("text")))).alias("parts"),
        )
    )
    joined = F.array_join(F.transform("parts", lambda p: p["text"]), "\n").cast("binary")
    return whole.unionByName(parts.select("head", joined.alias("record")))


def _without_return(record: Column) -> Column:
    last = F.substring(record, F.octet_length(record), F.lit(1)) == F.lit(b"\r")
    return F.when(last, F.substring(record, F.lit(1), F.octet_length(record) - 1)).otherwise(record)


def whole_records(spark: SparkSession, path: str) -> DataFrame | None:
    """``head, record``: the records of headered files and which of them are headers; None
    if every line is a record, so that Spark can split the files by itself."""
    lines = _lines(spark, path)
    text = F.col("line").cast("string")
    blank = F.btrim(text, F.lit(" \r")) == ""
    # Spark's split reading drops lines of blanks, and also cuts at carriage returns.
    inner_return = F.instr(text, "\r").between(1, F.octet_length("line") - 1)
    odd = (blank & (F.octet_length("line") > 1)) | inner_return
    splits_path = scratch_path(spark, "csv-splits")
    (
        lines.groupBy(*SPLIT)
        .agg(F.count_if(F.contains("line", F.lit(b'"'))).alias("quoted"), F.count_if(odd).alias("odd"))
        .write.parquet(splits_path)
    )
    splits = spark.read.parquet(splits_path)
    found = splits.agg(F.sum("quoted").alias("quoted"), F.sum("odd").alias("odd")).first()
    if not found["quoted"] and not found["odd"]:
        return None
    steps_path = scratch_path(spark, "csv-steps")
    lines.where(F.contains("line", F.lit(b'"'))).mapInArrow(_steps, STEPS).write.parquet(steps_path)
    steps = spark.read.parquet(steps_path)
    if not found["odd"] and steps.where("opens").isEmpty():
        return None
    # A split without a quote ends as it begins.
    all_steps = splits.select(*SPLIT).join(steps, SPLIT, "left").select(
        *SPLIT,
        *[F.coalesce(name, F.lit(name == "after_within")).alias(name) for name in ("opens", "after_outside", "closes", "after_within")],
    )
    states_path = scratch_path(spark, "csv-states")
    all_steps.groupBy("file").applyInPandas(_scan, STATES).write.parquet(states_path)
    states = spark.read.parquet(states_path)
    return _records(lines, states).withColumn("record", _without_return(F.col("record")).cast("string"))


def parsed(records: DataFrame, kinds: Sequence[str], **options) -> Column:
    """The fields of ``record`` as a struct of ``c0, c1, …`` of these types."""
    schema = ", ".join(f"c{k} {kind}" for k, kind in enumerate(kinds))
    return F.from_csv(records["record"], schema, {**OPTIONS, "multiLine": "true", **options})
