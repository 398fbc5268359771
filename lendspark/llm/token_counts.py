"""Tokens per document in flat token files.

Method: separator scan. A flat file holds the token ids of documents one after the other,
each followed by the end-of-document id, and has no index. Files are cut into blocks of a
fixed size wherever that falls, and each block is searched for the separator in one
vectorised comparison. A prefix scan over one summary row per block says how many
documents ended before a block and where the last of them did; with that, documents that
reach over any number of blocks get their full length.

Defined cases: NULL and empty texts are documents of no tokens. Tokens after the last
separator of a file are a document that is not closed, and count as one. A file without
tokens has no documents. An id that does not fit in ``width`` bytes fails the task. NULL or repeated ids are counted row by row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendspark.llm.common import partitions, stored
from lendspark.llm.files import attempt_name, open_folder
from lendspark.llm.tokens import narrow, tokenizer
from lendspark.session import scratch_path

TOTAL = -1
MANIFEST = "file STRING, ordinal BIGINT, doc_id BIGINT, bytes BIGINT"


@dataclass(frozen=True)
class Layout:
    """How the files are written: ``width`` bytes per id, little-endian, unsigned."""

    separator: int
    width: int = 2
    block: int = 4 << 20
    blocks_a_task: int = 16


def write_tokens(
    df: DataFrame, folder: str, tokenizer_path: str, layout: Layout, text: str, doc_id: str
) -> DataFrame:
    """Flat token files of the documents; returns which document is which in its file.

    Rows with ordinal -1 say how long a file is. Text that looks like a special token is
    ordinary text, so that only the separator separates.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(tokenizer_path, special_as_text=True).encode
        end = np.array([layout.separator], f"<u{layout.width}").tobytes()
        system, root = open_folder(folder)
        system.create_dir(root, recursive=True)
        name, file, size, ordinal = attempt_name(".bin"), None, 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                if file is None:
                    file = system.open_output_stream(f"{root}/{name}", compression=None)
                for ids in encode(part.column(1).to_pylist()):
                    size += file.write(narrow(ids, layout.width) + end)
                yield _rows(name, range(ordinal, ordinal + part.num_rows), part.column(0), None)
                ordinal += part.num_rows
        if file is not None:
            file.close()
            yield _rows(name, [TOTAL], pa.nulls(1, pa.int64()), size)

    rows = df.select(F.col(doc_id).cast("bigint"), F.coalesce(F.col(text), F.lit("")))
    return stored(rows.mapInArrow(run, MANIFEST), "token-files")


def _rows(name, ordinals, ids, size) -> pa.RecordBatch:
    count = len(ordinals)
    return pa.record_batch(
        [
            pa.array([name] * count, pa.string()),
            pa.array(ordinals, pa.int64()),
            ids,
            pa.array([size] * count, pa.int64()),
        ],
        names=["file", "ordinal", "doc_id", "bytes"],
    )


def scan(files: DataFrame, folder: str, layout: Layout) -> DataFrame:
    """``(file, ordinal, n_tokens)`` of the documents in ``files`` (``file, bytes``)."""
    step = layout.block // layout.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        for batch in batches:
            for name, block in zip(*[c.to_pylist() for c in batch.columns]):
                with system.open_input_file(f"{root}/{name}") as file:
                    data = file.read_at(layout.block, block * layout.block)
                ids = np.frombuffer(data, f"<u{layout.width}")
                ends = np.flatnonzero(ids == layout.separator) + block * step
                yield pa.record_batch(
                    [pa.array([name]), pa.array([block], pa.int64()), pa.array([ends], pa.list_(pa.int64()))],
                    names=["file", "block", "ends"],
                )

    last_block = F.floor((F.col("bytes") - 1) / layout.block)
    # Rows are small but what they name is not, so tasks follow from the bytes.
    count = files.where("bytes > 0").agg(F.sum(last_block + 1)).first()[0] or 1
    blocks = (
        files.where("bytes > 0")
        .select("file", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)).alias("block"))
        .repartition(min(count, max(partitions(files), -(-count // layout.blocks_a_task))), "file", "block")
        .mapInArrow(run, "file STRING, block BIGINT, ends ARRAY<BIGINT>")
    )
    found = stored(blocks, "separators")

    summary = found.select(
        "file", "block", F.size("ends").alias("n"), F.try_element_at("ends", F.lit(-1)).alias("last")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = summary.select(
        "file",
        "block",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
        F.coalesce(F.max("last").over(before), F.lit(-1)).cast("bigint").alias("previous"),
    )
    starts = F.concat(F.array("previous"), F.slice("ends", 1, F.greatest(F.size("ends") - 1, F.lit(0))))
    closed = (
        found.where(F.size("ends") > 0)
        .join(stitched, ["file", "block"])
        .select("file", "base", F.posexplode(F.arrays_zip(starts.alias("start"), F.col("ends").alias("end"))))
        .select(
            "file",
            (F.col("base") + F.col("pos")).alias("ordinal"),
            (F.col("col.end") - F.col("col.start") - 1).alias("n_tokens"),
        )
    )
    left = F.col("bytes") / layout.width - 1 - F.coalesce("last", F.lit(-1))
    open_ends = (
        summary.groupBy("file")
        .agg(F.sum("n").alias("ordinal"), F.max("last").alias("last"))
        .join(files, "file")
        .select("file", "ordinal", left.cast("bigint").alias("n_tokens"))
        .where("n_tokens > 0")
    )
    return closed.union(open_ends)


def count_tokens(
    df: DataFrame,
    tokenizer_path: str,
    layout: Layout,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """``(doc_id, n_tokens)`` of each row of ``df``, from token files written and scanned."""
    folder = scratch_path(df.sparkSession, "tokens")
    manifest = write_tokens(df, folder, tokenizer_path, layout, text, doc_id)
    files = manifest.where(F.col("ordinal") == TOTAL).select("file", "bytes")
    documents = manifest.where(F.col("ordinal") >= 0).select("file", "ordinal", "doc_id")
    return documents.join(scan(files, folder, layout), ["file", "ordinal"]).select("doc_id", "n_tokens")
