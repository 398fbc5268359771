"""Web archives: writing, indexing, and reading selected records.

Method: index first. While records are written, each one's file, offset, length, URL and
digest are kept as a table. To read, records are chosen in that table, their byte ranges
are sorted within their files, ranges that lie close together are fetched as one, and
only those bytes are read.

A record is a compressed member of its own, so a range can be read without what is
around it. A file belongs to one attempt at one task, and the table names only files of
attempts that succeeded. The table is stored before anything is read, so a lost executor
costs a task, never a second version of the archive.

Defined cases: NULL html is an empty payload. Of equal payloads of the least length or
more, the smallest id is a full response and the others refer to it; rows without an id,
or that share the smallest one, are full responses. Blanks and control characters in a
URL are percent-encoded; a NULL URL is left out of the record. No rows: an empty table.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote
from uuid import NAMESPACE_URL, uuid5

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.llm.common import partitions, stored
from lendspark.llm.files import attempt_name, open_folder
from lendspark.session import scratch_path

VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
# A field of our own: a record that refers to another does not hold the payload.
PAYLOAD_LENGTH = "X-Payload-Length"
INDEX = (
    "file STRING, offset BIGINT, length BIGINT, url STRING, digest STRING, page_id BIGINT,"
    " record_type STRING"
)


@dataclass(frozen=True)
class Archive:
    """Settings. Ranges closer than ``gap`` bytes are fetched together, up to ``span``
    bytes; a reading task gets about ``share`` bytes of one file."""

    least_shared: int = 100
    date: str = "1970-01-01T00:00:00Z"
    level: int = 5
    gap: int = 64 << 10
    span: int = 8 << 20
    share: int = 32 << 20


def with_first(pages: DataFrame, settings: Archive) -> DataFrame:
    """``page_id, url, html, refers_to``: the smallest other id with the same payload.

    Only payloads that occur more than once are looked up; a payload that very many
    pages share is one row on that side, and its pages can be split.
    """
    payload = F.coalesce("html", F.lit(""))
    keyed = pages.withColumns({"html": payload, "_digest": F.unhex(F.sha2(payload, 256))})
    firsts = (
        keyed.where(F.octet_length("html") >= settings.least_shared)
        .groupBy("_digest")
        .agg(F.min("page_id").alias("_first"), F.count("*").alias("_n"))
        .where("_n > 1")
        .select("_digest", "_first")
    )
    other = F.when(F.col("page_id") != F.col("_first"), F.col("_first"))
    return keyed.join(firsts, "_digest", "left").select(
        "page_id", "url", "html", other.alias("refers_to")
    )


def record(page_id, url, payload: bytes, digest: str, refers_to, settings: Archive) -> bytes:
    """One record with its header, not compressed."""
    kind = "response" if refers_to is None else "revisit"
    name = lambda key: f"<urn:uuid:{uuid5(NAMESPACE_URL, f'page:{key}')}>"
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", name(page_id)),
        ("WARC-Date", settings.date),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        (PAYLOAD_LENGTH, len(payload)),
    ]
    if page_id is not None:
        fields.append(("X-Page-Id", page_id))
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
    body = HTTP_HEAD % len(payload)
    if refers_to is None:
        body += payload
    else:
        fields += [
            ("WARC-Profile", SAME_PAYLOAD),
            ("WARC-Refers-To", name(refers_to)),
            ("X-Refers-To-Page-Id", refers_to),
        ]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(body))]
    head = "".join(f"{key}: {value}\r\n" for key, value in fields)
    return f"{VERSION}\r\n{head}\r\n".encode() + body + b"\r\n\r\n"


def write_archive(pages: DataFrame, folder: str, settings: Archive = Archive()) -> DataFrame:
    """Archives of ``page_id, url, html`` under ``folder``; returns the stored index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        system.create_dir(root, recursive=True)
        name, offset, file = attempt_name(".warc.gz"), 0, None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for page_id, url, html, refers_to in zip(*[c.to_pylist() for c in batch.slice(at, 256).columns]):
                    payload = html.encode()
                    digest = hashlib.sha256(payload).hexdigest()
                    member = gzip.compress(
                        record(page_id, url, payload, digest, refers_to, settings), settings.level, mtime=0
                    )
                    if file is None:
                        file = system.open_output_stream(f"{root}/{name}", compression=None)
                    file.write(member)
                    kind = "response" if refers_to is None else "revisit"
                    rows.append((name, offset, len(member), url, digest, page_id, kind))
                    offset += len(member)
                if rows:
                    yield _batch(rows, INDEX)
        # Only a file that is closed is complete, and only then does the task end.
        if file is not None:
            file.close()

    return stored(with_first(pages, settings).mapInArrow(run, INDEX), "warc-index")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"STRING": pa.string(), "BIGINT": pa.int64(), "BINARY": pa.binary()}
    fields = [field.split() for field in schema.split(",")]
    return pa.record_batch(
        [pa.array(column, kinds[kind]) for column, (_, kind) in zip(zip(*rows), fields)],
        names=[name for name, _ in fields],
    )


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and content of a compressed record."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != VERSION:
        raise ValueError(f"Not a record: {version[:20]}")
    fields = dict(line.split(": ", 1) for line in lines)
    return fields, rest[: int(fields["Content-Length"])]


def spans(ranges: list[tuple[int, int]], gap: int, most: int) -> Iterator[list[tuple[int, int]]]:
    """Sorted ``(offset, length)`` in groups that are fetched at once."""
    group: list[tuple[int, int]] = []
    for offset, length in ranges:
        if group and (
            offset - sum(group[-1]) > gap or offset + length - group[0][0] > most
        ):
            yield group
            group = []
        group.append((offset, length))
    if group:
        yield group


READ = (
    "page_id BIGINT, payload_bytes BIGINT, payload_digest STRING, record_type STRING,"
    " refers_to BIGINT, url STRING, payload BINARY"
)


def read_records(chosen: DataFrame, folder: str, settings: Archive = Archive()) -> DataFrame:
    """The records whose index rows are in ``chosen``; ``payload`` is NULL for those that
    refer to another. A payload that does not have its digest fails the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        for batch in batches:
            ranges: dict[str, list[tuple[int, int]]] = {}
            for name, offset, length in zip(*[c.to_pylist() for c in batch.columns]):
                ranges.setdefault(name, []).append((offset, length))
            for name, wanted in ranges.items():
                with system.open_input_file(f"{root}/{name}") as file:
                    for group in spans(sorted(wanted), settings.gap, settings.span):
                        yield fetched(file, group)

    def fetched(file, group):
        start = group[0][0]
        data = file.read_at(sum(group[-1]) - start, start)
        rows = []
        for offset, length in group:
            fields, body = parse(data[offset - start : offset - start + length])
            number = lambda key: int(fields[key]) if key in fields else None
            kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
            payload = body.partition(b"\r\n\r\n")[2] if kind == "response" else None
            size = number(PAYLOAD_LENGTH)
            if payload is not None:
                size = len(payload)
                if hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"Payload of page {fields.get('X-Page-Id')} is damaged")
            rows.append(
                (
                    number("X-Page-Id"),
                    size,
                    digest,
                    kind,
                    number("X-Refers-To-Page-Id"),
                    fields.get("WARC-Target-URI"),
                    payload,
                )
            )
        return _batch(rows, READ)

    part = F.floor(F.col("offset") / settings.share)
    # Index rows are small but what they name is not, so tasks follow from the bytes.
    total = chosen.agg(F.sum("length")).first()[0] or 0
    tasks = max(partitions(chosen), -(-total // settings.share))
    dealt = (
        chosen.select("file", "offset", "length", part.alias("part"))
        .repartition(tasks, "file", "part")
        .sortWithinPartitions("file", "offset")
    )
    return dealt.select("file", "offset", "length").mapInArrow(run, READ)


def round_trip(
    df: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    settings: Archive = Archive(),
) -> DataFrame:
    """``df`` written as archives in a new shared folder and read back, all records."""
    folder = scratch_path(df.sparkSession, "warc")
    pages = df.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")
    )
    return read_records(write_archive(pages, folder, settings), folder, settings)
