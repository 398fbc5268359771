"""Token ids as binary files from which single documents can be read.

Method: shared zstandard dictionary. Documents are serialized as arrays of ids, and a
dictionary is trained on such arrays. Every document is compressed on its own with that
dictionary, so that a short one takes few bytes and is read without its neighbours. A file
carries the hash of its dictionary, and at its end an index of offsets; a reader that
holds another dictionary refuses the file.

A file is a header (magic, width of an id in bytes, SHA-256 of the dictionary), one frame
per document, the index (per document its id, whether it has one, where its frame starts,
how long it is, and its number of ids; little-endian 64-bit integers), and a tail (where
the index starts, its rows, magic). Files are in the order of their documents' ids, and so
are the documents within a file.

Texts are dealt by ranges of id and content before they are tokenized, so each task
streams its sorted share into one file; the number of ranges follows from the bytes of
text. The dictionary comes from a bounded sample: the documents of least hash among those
of at most ``sample_bytes`` bytes.

Defined cases: a NULL text is an empty one and gives the end id alone. Rows without an id
come first; rows that share an id are ordered by content, and those that agree in it too
are interchangeable. Without enough documents to train on, the sampled arrays themselves
are the dictionary; without any, there is none, and its hash is that of no bytes. No rows
give no files and no rows. Other columns are not read. An id that does not fit the width
fails the task.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendspark.llm.common import partitions, stored
from lendspark.llm.files import attempt_name, open_folder
from lendspark.llm.tokens import narrow, tokenizer
from lendspark.session import scratch_path

MAGIC = b"TOKARCH1"
HEAD, TAIL = "<8sI32s", "<QQ8s"
INDEX_ROW = np.dtype([("doc_id", "<i8"), ("known", "<i8"), ("offset", "<i8"), ("length", "<i8"), ("n_ids", "<i8")])
FILES = "file STRING, part INT, documents BIGINT, ids BIGINT, bytes BIGINT"


@dataclass(frozen=True)
class Archive:
    """Settings. ``width`` is the bytes of an id in the files, ``file_bytes`` about the text
    that one file gets, ``read_bytes`` about the frames that one reading task gets."""

    tokenizer_path: str
    separator: int = 0
    width: int = 2
    level: int = 3
    dictionary_bytes: int = 64 << 10
    sample: int = 1000
    sample_bytes: int = 8 << 10
    file_bytes: int = 128 << 20
    read_bytes: int = 32 << 20


def _with_end(settings: Archive):
    encode = tokenizer(settings.tokenizer_path).encode
    end = struct.pack("<I", settings.separator)
    return lambda texts: [narrow(ids + end, settings.width) for ids in encode(texts)]


def train_dictionary(df: DataFrame, settings: Archive, text: str = "text") -> bytes:
    """The dictionary for the documents of ``df``, trained in one task on the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serialized = _with_end(settings)
        samples = [x for batch in batches for x in serialized(batch.column(0).to_pylist())]
        try:
            trained = zstandard.train_dictionary(settings.dictionary_bytes, samples).as_bytes()
        except zstandard.ZstdError:
            trained = b"".join(samples)[: settings.dictionary_bytes]
        yield pa.record_batch([pa.array([trained], pa.binary())], names=["dictionary"])

    content = F.coalesce(F.col(text), F.lit(""))
    sampled = (
        df.select(content.alias("text"))
        .where(F.octet_length("text").between(1, settings.sample_bytes))
        .orderBy(F.xxhash64("text"))
        .limit(settings.sample)
    )
    rows = sampled.coalesce(1).mapInArrow(run, "dictionary BINARY").collect()
    return bytes(rows[0]["dictionary"]) if rows else b""


def _codec(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def write(
    df: DataFrame,
    folder: str,
    settings: Archive,
    dictionary: bytes,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Files of the documents of ``df`` in ``folder``; returns the stored list of files.

    ``part`` orders the files. The list names only what finished attempts wrote.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        content.alias("text"),
        F.xxhash64(content).alias("content"),
        F.monotonically_increasing_id().alias("tie"),
    )
    size = rows.agg(F.sum(F.octet_length("text") + INDEX_ROW.itemsize)).first()[0] or 0
    order = ["doc_id", "content", "tie"]
    parts = max(partitions(df), -(-size // settings.file_bytes))
    digest = sha256(dictionary).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        system.create_dir(root, recursive=True)
        serialized = _with_end(settings)
        press = zstandard.ZstdCompressor(level=settings.level, dict_data=_codec(dictionary)).compress
        name, file, at, index = attempt_name(".tok"), None, struct.calcsize(HEAD), []
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                if file is None:
                    file = system.open_output_stream(f"{root}/{name}", compression=None)
                    file.write(struct.pack(HEAD, MAGIC, settings.width, digest))
                rows = np.zeros(part.num_rows, INDEX_ROW)
                for k, (key, ids) in enumerate(zip(part.column(0).to_pylist(), serialized(part.column(1).to_pylist()))):
                    frame = press(ids)
                    file.write(frame)
                    rows[k] = (key or 0, key is not None, at, len(frame), len(ids) // settings.width)
                    at += len(frame)
                index.append(rows)
        if file is not None:
            whole = np.concatenate(index)
            file.write(whole.tobytes() + struct.pack(TAIL, at, len(whole), MAGIC))
            # Only a file that is closed is complete, and only then does the task end.
            file.close()
            total = at + whole.nbytes + struct.calcsize(TAIL)
            values = (name, TaskContext.get().partitionId(), len(whole), int(whole["n_ids"].sum()), total)
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch(
                [pa.array([v], kind) for v, kind in zip(values, kinds)],
                names=[field.split()[0] for field in FILES.split(", ")],
            )

    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    files = stored(dealt.select("doc_id", "text").mapInArrow(run, FILES), "token-archive")
    system, root = open_folder(folder)
    system.create_dir(root, recursive=True)
    with system.open_output_stream(f"{root}/{digest.hex()}.dict", compression=None) as file:
        file.write(dictionary)
    return files


def open_archive(folder: str, name: str, dictionary: bytes):
    """The open file, its index, and the width of its ids; refuses another dictionary."""
    system, root = open_folder(folder)
    file = system.open_input_file(f"{root}/{name}")
    magic, width, digest = struct.unpack(HEAD, file.read_at(struct.calcsize(HEAD), 0))
    if magic != MAGIC or digest != sha256(dictionary).digest():
        file.close()
        raise ValueError(f"{name} was written with another dictionary")
    at, rows, _ = struct.unpack(TAIL, file.read_at(struct.calcsize(TAIL), file.size() - struct.calcsize(TAIL)))
    index = np.frombuffer(file.read_at(rows * INDEX_ROW.itemsize, at), INDEX_ROW)
    return file, index, width


def read_document(folder: str, name: str, dictionary: bytes, place: int) -> np.ndarray:
    """The ids of one document: one look into the index and one short read."""
    file, index, width = open_archive(folder, name, dictionary)
    with file:
        row = index[place]
        frame = file.read_at(int(row["length"]), int(row["offset"]))
    ids = zstandard.ZstdDecompressor(dict_data=_codec(dictionary)).decompress(
        frame, max_output_size=int(row["n_ids"]) * width
    )
    return np.frombuffer(ids, f"<u{width}")


def load_dictionary(folder: str, digest: str) -> bytes:
    system, root = open_folder(folder)
    with system.open_input_stream(f"{root}/{digest}.dict", compression=None) as file:
        return file.read()


READ = "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids BINARY"


def read(
    files: DataFrame, folder: str, settings: Archive, dictionary: bytes, keep_ids: bool = True
) -> DataFrame:
    """Every document in ``files`` in order of ids: ``doc_id, start, n_tokens, ids``.

    ``start`` counts the ids of all documents before it, in all files. ``ids`` are unsigned
    32-bit integers, and their checksum ``ids_crc32`` stands beside them; without
    ``keep_ids`` it stands alone. A file is read by as many tasks as its size asks for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor(dict_data=_codec(dictionary)).decompress
        for batch in batches:
            for name, base, piece, pieces in zip(*[c.to_pylist() for c in batch.columns]):
                file, index, width = open_archive(folder, name, dictionary)
                with file:
                    before = np.cumsum(index["n_ids"]) - index["n_ids"] + base
                    first, last = (len(index) * k // pieces for k in (piece, piece + 1))
                    for at in range(first, last, 256):
                        yield documents(file, index[at : min(at + 256, last)], before[at : min(at + 256, last)], width, unpack)

    def documents(file, rows, starts, width, unpack):
        begin = int(rows["offset"][0])
        data = file.read_at(int(rows["offset"][-1] + rows["length"][-1]) - begin, begin)
        found, sums = [], []
        for offset, length, n in zip((rows["offset"] - begin).tolist(), rows["length"].tolist(), rows["n_ids"].tolist()):
            ids = unpack(data[offset : offset + length], max_output_size=n * width)
            ids = np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes()
            sums.append(zlib.crc32(ids))
            found.append(ids if keep_ids else None)
        return pa.record_batch(
            [
                pa.array(rows["doc_id"], mask=rows["known"] == 0),
                pa.array(starts),
                pa.array(rows["n_ids"].astype(np.int64)),
                pa.array(found, pa.binary()),
                pa.array(sums, pa.int64()),
            ],
            names=["doc_id", "start", "n_tokens", "ids", "ids_crc32"],
        )

    # One row per file, each of which stands for about ``file_bytes`` of text.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = F.ceil(F.col("bytes") / settings.read_bytes)
    dealt = (
        files.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))
        .withColumn("pieces", pieces)
        .select("file", "base", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)).alias("piece"), "pieces")
    )
    count = files.agg(F.sum(pieces)).first()[0] or 1
    spread = dealt.repartition(int(count), "file", "piece")
    out = spread.mapInArrow(run, f"{READ}, ids_crc32 BIGINT")
    return out if keep_ids else out.drop("ids")


def round_trip(
    df: DataFrame, settings: Archive, text: str = "text", doc_id: str = "doc_id", keep_ids: bool = True
) -> DataFrame:
    """``df`` written to a new folder in the shared space and read back."""
    folder = scratch_path(df.sparkSession, "tokens")
    dictionary = train_dictionary(df, settings, text)
    files = write(df, folder, settings, dictionary, text, doc_id)
    return read(files, folder, settings, dictionary, keep_ids)
