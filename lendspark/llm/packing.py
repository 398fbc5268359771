"""Token sequences of a fixed length, packed from whole documents.

Method: bounded-space online best fit. A task packs the documents it reads into a fixed
number of open bins. A bitset keyed by free space finds the open bin that a piece fits
most tightly; if too many bins are open, the fullest closes. No document moves between
tasks, and the memory of a task is bounded by the bins and one buffer.

Defined cases: a NULL text is empty and gives one piece that holds the separator alone.
Only documents longer than a sequence are cut. NULL or repeated ids are packed like any
other. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.llm.common import in_arrow
from lendspark.llm.tokens import tokenizer

ID_BYTES = 4
SCHEMA = (
    "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids BINARY,"
    " sequence_id BIGINT, offset BIGINT"
)


@dataclass(frozen=True)
class Packing:
    """Settings. ``buffer`` pieces are placed longest first before more are read."""

    tokenizer_path: str
    capacity: int = 2048
    separator: int = 0
    open_bins: int = 4096
    buffer: int = 4096


class OpenBins:
    """Bins with room, by free space."""

    def __init__(self, capacity: int, most: int, first_id: int):
        self.capacity, self.most, self.next_id = capacity, most, first_id
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.spaces = 0
        self.count = 0

    def _take(self, space: int) -> int:
        bins = self.by_space[space]
        found = bins.pop()
        if not bins:
            self.spaces ^= 1 << space
        self.count -= 1
        return found

    def _put(self, bin_id: int, space: int) -> None:
        self.by_space[space].append(bin_id)
        self.spaces |= 1 << space
        self.count += 1

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset for a piece of at least one and at most ``capacity`` tokens."""
        roomy = self.spaces >> length
        if roomy:
            space = length + (roomy & -roomy).bit_length() - 1
            bin_id = self._take(space)
        else:
            space, bin_id = self.capacity, self.next_id
            self.next_id += 1
        if space > length:
            self._put(bin_id, space - length)
            if self.count > self.most:
                self._take((self.spaces & -self.spaces).bit_length() - 1)
        return bin_id, self.capacity - space


def _place_all(pieces: list[tuple], bins: OpenBins, types: pa.Schema) -> pa.RecordBatch:
    pieces.sort(key=lambda piece: -len(piece[3]))
    rows = []
    for doc_id, number, start, ids in pieces:
        length = len(ids) // ID_BYTES
        bin_id, offset = bins.place(length)
        rows.append((doc_id, number, start, length, ids, bin_id, offset))
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types.types)], types)


def pack(df: DataFrame, settings: Packing, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per piece, with its token ids as unsigned 32-bit integers in ``ids``.

    ``sequence_id`` and ``offset`` say where the piece lies; the numbers of sequences
    have gaps.
    """
    types = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("piece", pa.int32()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids", pa.binary()),
            ("sequence_id", pa.int64()),
            ("offset", pa.int64()),
        ]
    )
    end = settings.separator.to_bytes(ID_BYTES, "little")
    step = settings.capacity * ID_BYTES

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(settings.tokenizer_path).encode
        task = TaskContext.get().partitionId()
        bins = OpenBins(settings.capacity, settings.open_bins, task << 32)
        waiting: list[tuple] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for key, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                    ids += end
                    waiting += [
                        (key, k, cut // ID_BYTES, ids[cut : cut + step])
                        for k, cut in enumerate(range(0, len(ids), step))
                    ]
                if len(waiting) >= settings.buffer:
                    yield _place_all(waiting, bins, types)
                    waiting = []
        if waiting:
            yield _place_all(waiting, bins, types)

    rows = df.select(F.col(doc_id).cast("bigint"), F.coalesce(F.col(text), F.lit("")))
    return in_arrow(rows, packed, SCHEMA)
