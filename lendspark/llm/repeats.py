"""Byte strings that texts repeat, at any place, whole or in part.

Method: longest-previous-factor arrays over suffixes. Suffixes are sorted by their first
``length`` bytes, ties by position. In that order the previous and the next smaller
position of a suffix give its longest earlier match, cut off at ``length``; and as the
suffixes that agree so far stand next to each other, they are the neighbours. A suffix
with an earlier match of full length is a later copy; one with only a later match is the
first.

One suffix array of a whole corpus would be sorted in one place, so suffixes are first
brought together that can match at all. Of the short grams in a window of ``length``
bytes, the one with the least hash is the window's anchor; equal windows have equal
anchors at equal places. The windows of a text fall into runs with a common anchor.
Runs that agree entirely are settled by counting; only runs whose anchor occurs with
different surroundings, once each, are gathered by anchor, as bytes, and sorted.
An anchor with very many different surroundings is not gathered but settled by counting
its windows one by one, across all tasks.

Defined cases: a NULL text is empty. Texts shorter than ``length`` keep everything.
Copies of a text are worked on once; each counts as an occurrence. The first occurrence
is that in the text with the smallest id, and there the first; a text none of whose rows
has an id comes before all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.llm.common import content_key, partitions, stored
from lendspark.llm.shingles import U64, mixed, running_sum, stretch_hashes
from lendspark.session import scratch_path

KEY = ["k1", "k2"]
CHUNK_BYTES = 128 << 10
PLACE_BITS = 24
GATHERED_BYTES = 512 << 10


@dataclass(frozen=True)
class Repeats:
    """Settings. ``surroundings`` bounds the runs of an anchor that are gathered."""

    length: int = 400
    gram: int = 128
    surroundings: int = 20_000


def distinct_texts(df: DataFrame, text: str, doc_id: str) -> DataFrame:
    """One row per text, bucketed by its key: ``k1, k2, least_id, copies, text``.

    The buckets let every later step meet the texts without moving them again.
    """
    spark = df.sparkSession
    content = F.coalesce(F.col(text), F.lit(""))
    k1, k2 = content_key(content)
    name = f"texts_{uuid4().hex}"
    (
        df.select(k1.alias("k1"), k2.alias("k2"), F.col(doc_id).alias("id"), content.alias("text"))
        .groupBy(*KEY)
        .agg(
            F.min("id").cast("bigint").alias("least_id"),
            F.count("*").alias("copies"),
            F.first("text").alias("text"),
        )
        .write.bucketBy(partitions(df), *KEY)
        .option("path", scratch_path(spark, "texts"))
        .saveAsTable(name)
    )
    return spark.table(name)


def _least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in turn."""
    count = len(values) - width + 1
    fill = np.full(-len(values) % width, ~U64(0), U64)
    table = np.concatenate([values, fill]).reshape(-1, width)
    so_far = np.minimum.accumulate(table, axis=1).ravel()
    to_come = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(to_come[:count], so_far[width - 1 : width - 1 + count])


def anchored_runs(texts: list[bytes], settings: Repeats) -> tuple[np.ndarray, ...]:
    """Of all windows of the texts: ``(text, first, last, gram, region)`` per run.

    ``first`` and ``last`` are where windows start within their text; ``region`` is the
    hash of all bytes of the run together with the place of the anchor in it.
    """
    size, gram = settings.length, settings.gram
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    if len(buffer) < size:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    ends = np.cumsum(lengths)
    sums = running_sum(buffer)
    places = np.arange(len(buffer) - gram + 1)
    grams = stretch_hashes(sums, places, places + gram)
    low = U64(PLACE_BITS)
    least = _least_in_windows((grams >> low << low) | places.astype(U64), size - gram + 1)
    text = np.repeat(np.arange(len(texts)), lengths)[: len(least)]
    starts = np.flatnonzero(np.arange(len(least)) + size <= ends[text])
    anchor = (least[starts] & U64((1 << PLACE_BITS) - 1)).astype(np.int64)
    owner = text[starts]
    change = np.ones(len(starts), bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(change)
    first, last = starts[at], starts[np.append(at[1:], len(starts)) - 1]
    anchor, owner = anchor[at], owner[at]
    region = mixed(stretch_hashes(sums, first, last + size) + (anchor - first).astype(U64))
    begin = (ends - lengths)[owner]
    return owner, first - begin, last - begin, grams[anchor], region


def _text_chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in turn, in chunks whose places fit; a longer text is a chunk of its own."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK_BYTES:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, texts[first:]


def _text_runs(text: bytes, settings: Repeats) -> tuple[np.ndarray, ...]:
    """As :func:`anchored_runs` for one text of any length, by overlapping pieces.

    Pieces overlap by all but one byte of a window, so each window is in one piece; a run
    cut in two stays two runs, whose windows are the same.
    """
    found = []
    for at in range(0, max(1, len(text) - settings.length + 1), CHUNK_BYTES):
        piece = text[at : at + CHUNK_BYTES + settings.length - 1]
        owner, first, last, gram, region = anchored_runs([piece], settings)
        found.append((owner, first + at, last + at, gram, region))
    return tuple(np.concatenate(columns) for columns in zip(*found))


def runs(texts: DataFrame, settings: Repeats) -> DataFrame:
    """The runs of every text, one row for all that are equal in a text.

    ``k1, k2, least_id, first, last`` of the first of them, ``gram, region``, and in
    ``firsts`` where all of them start. So a text that goes on repeating itself gives few
    rows.
    """

    def distinct(owner, first, last, gram, region):
        order = np.lexsort((first, region, gram, owner))
        same = np.ones(len(order), bool)
        for values in (owner, gram, region):
            same[1:] &= values[order[1:]] == values[order[:-1]]
        same[:1] = False
        heads = np.flatnonzero(~same)
        firsts = pa.ListArray.from_arrays(
            pa.array(np.append(heads, len(order)).astype(np.int32)), pa.array(first[order])
        )
        at = order[heads]
        return owner[at], [first[at], last[at], gram[at], region[at]], firsts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                contents = [text.encode() for text in part.column(3).to_pylist()]
                for start, chunk in _text_chunks(contents):
                    many = len(chunk) > 1 or len(chunk[0]) <= CHUNK_BYTES
                    owner, first, last, gram, region = (
                        anchored_runs(chunk, settings) if many else _text_runs(chunk[0], settings)
                    )
                    if len(owner) == 0:
                        continue
                    owner, numbers, firsts = distinct(owner, first, last, gram, region)
                    whose = pa.array(owner + start)
                    yield pa.record_batch(
                        [
                            *[column.take(whose) for column in part.columns[:3]],
                            *[pa.array(x.view(np.int64)) for x in numbers],
                            firsts,
                        ],
                        names=["k1", "k2", "least_id", "first", "last", "gram", "region", "firsts"],
                    )

    long_enough = texts.where(F.octet_length("text") >= settings.length)
    schema = (
        "k1 BIGINT, k2 BIGINT, least_id BIGINT, first BIGINT, last BIGINT, gram BIGINT,"
        " region BIGINT, firsts ARRAY<BIGINT>"
    )
    return long_enough.select("k1", "k2", "least_id", "text").mapInArrow(run, schema)


def _dense(values: np.ndarray) -> np.ndarray:
    """Values replaced by their rank among the distinct ones."""
    order = np.argsort(values)
    ordered = values[order]
    rank = np.empty(len(values), np.int64)
    rank[order] = np.cumsum(np.diff(ordered, prepend=ordered[:1]) != 0)
    return rank


def _ahead(values: np.ndarray, step: int) -> np.ndarray:
    moved = np.zeros_like(values)
    moved[: max(0, len(values) - step)] = values[step:]
    return moved


def suffix_classes(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of the suffix at each place by its first ``length`` bytes, by doubling.

    ``data`` holds bytes raised by one, and zero after each string and at the end.
    Suffixes have equal ranks if they agree that far, or to where both their strings end.
    """
    reach = min(7, length)  # so many values of 9 bits make up one number
    start = np.zeros(len(data), np.int64)
    for k in range(reach):
        start = (start << 9) | _ahead(data, k)
    rank = _dense(start)
    while reach < length:
        step = min(reach, length - reach)
        rank = _dense(rank * (int(rank.max()) + 1) + _ahead(rank, step))
        reach += step
    return rank


def matches(regions: list[bytes], n_windows: list[int], length: int) -> tuple[np.ndarray, ...]:
    """Per window in turn: whether an earlier, and whether a later one has the same bytes.

    Regions come in the order of their occurrences.
    """
    joined = np.frombuffer(b"\0".join(regions) + b"\0", np.uint8).astype(np.int64) + 1
    sizes = np.fromiter(map(len, regions), np.int64, len(regions))
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    joined[begins + sizes] = 0
    counts = np.asarray(n_windows)
    starts = np.repeat(begins - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    rank = suffix_classes(joined, length)[starts]
    # The order of suffixes; equal ones in order of position, so the one before has the
    # next smaller position among them and matches longest, and so does the one after.
    order = np.argsort(rank, kind="stable")
    agree = np.diff(rank[order]) == 0
    earlier, later = np.zeros(len(rank), bool), np.zeros(len(rank), bool)
    earlier[order[1:]] = agree
    later[order[:-1]] = agree
    return earlier, later


def _intervals(flags: np.ndarray, base: int) -> list[dict]:
    edge = np.flatnonzero(np.diff(flags.view(np.int8), prepend=0, append=0))
    return [{"a": int(x) + base, "b": int(y) - 1 + base} for x, y in zip(edge[::2], edge[1::2])]


SPANS = "ARRAY<STRUCT<a: BIGINT, b: BIGINT>>"
ARROW_SPANS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _regions(contested: DataFrame, texts: DataFrame, settings: Repeats) -> DataFrame:
    """The bytes of each contested run: ``gram, region, place, n, bytes``."""
    wanted = contested.groupBy("place.k1", "place.k2").agg(
        F.collect_list(F.struct("gram", "region", "place")).alias("runs")
    )
    size = settings.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                text = batch.column(0)[at].as_py().encode()
                asked = batch.column(1).slice(at, 1).flatten()
                place = asked.field("place")
                firsts, lasts = place.field("first").to_pylist(), place.field("last").to_pylist()
                yield pa.record_batch(
                    [
                        asked.field("gram"),
                        asked.field("region"),
                        place,
                        pa.array([b - a + 1 for a, b in zip(firsts, lasts)], pa.int64()),
                        pa.array([text[a : b + size] for a, b in zip(firsts, lasts)], pa.binary()),
                    ],
                    names=["gram", "region", "place", "n", "bytes"],
                )

    place = contested.schema["place"].dataType.simpleString()
    return texts.select(*KEY, "text").join(wanted, KEY).select("text", "runs").mapInArrow(
        run, f"gram BIGINT, region BIGINT, place {place}, n BIGINT, bytes BINARY"
    )


def _sorted_suffixes(regions: DataFrame, settings: Repeats) -> DataFrame:
    """``gram, region, any, earlier``: intervals of windows with a match, by suffix order."""

    def settled(rows: pa.Table) -> pa.RecordBatch:
        counts = rows.column("n").to_pylist()
        earlier, later = matches(rows.column("bytes").to_pylist(), counts, settings.length)
        cuts = np.cumsum(counts)[:-1]
        spans = lambda flags: pa.array([_intervals(f, 0) for f in np.split(flags, cuts)], ARROW_SPANS)
        return pa.record_batch(
            [
                rows.column("gram").combine_chunks(),
                rows.column("region").combine_chunks(),
                spans(earlier | later),
                spans(earlier),
            ],
            names=["gram", "region", "any", "earlier"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            if held.nbytes >= GATHERED_BYTES:
                gram = held.column("gram").to_numpy()
                whole = int(np.searchsorted(gram, gram[-1]))  # the last may go on
                if whole:
                    yield settled(held.slice(0, whole))
                    held = held.slice(whole).combine_chunks()
        if held is not None and held.num_rows:
            yield settled(held)

    gathered = (
        regions.repartition("gram")
        .sortWithinPartitions("gram", "place")
        .select("gram", "region", "n", "bytes")
    )
    return gathered.mapInArrow(run, f"gram BIGINT, region BIGINT, any {SPANS}, earlier {SPANS}")


def _counted_windows(regions: DataFrame, settings: Repeats) -> DataFrame:
    """The same for anchors with too many surroundings: every window by its hash."""
    size = settings.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                count = row.column("n")[0].as_py()
                sums = running_sum(np.frombuffer(row.column("bytes")[0].as_py(), np.uint8))
                starts = np.arange(count)
                repeat = pa.array(np.zeros(count, np.int64))
                yield pa.record_batch(
                    [
                        *row.select(["gram", "region", "place"]).take(repeat).columns,
                        pa.array(starts),
                        pa.array(stretch_hashes(sums, starts, starts + size).view(np.int64)),
                    ],
                    names=["gram", "region", "place", "at", "window"],
                )

    kinds = dict(regions.dtypes)
    windows = regions.mapInArrow(
        run, f"gram BIGINT, region BIGINT, place {kinds['place']}, at BIGINT, window BIGINT"
    )
    windows = stored(windows.withColumn("order", F.struct("place", "at")), "windows")
    repeated = (
        windows.groupBy("gram", "window")
        .agg(F.count("*").alias("times"), F.min("order").alias("least"))
        .where("times > 1")
    )
    one = F.struct(F.col("at").alias("a"), F.col("at").alias("b"))
    return (
        windows.join(repeated, ["gram", "window"])
        .groupBy("gram", "region")
        .agg(
            F.collect_list(one).alias("any"),
            F.collect_list(F.when(F.col("order") != F.col("least"), one)).alias("earlier"),
        )
    )


def repeated_windows(texts: DataFrame, settings: Repeats, keep_first: bool) -> DataFrame:
    """``k1, k2, spans``: where windows to be removed start, as closed intervals."""
    every = stored(runs(texts, settings), "runs")
    shared = every.groupBy("gram").agg(F.sum(F.size("firsts")).alias("n")).where("n > 1")
    candidates = stored(every.join(shared, "gram", "left_semi"), "shared-runs")
    place = F.struct("least_id", "k1", "k2", "first", "last")
    classes = candidates.groupBy("gram", "region").agg(
        F.sum(F.size("firsts")).alias("times"), F.min(place).alias("place")
    )
    classes = stored(classes, "run-classes")
    kinds = classes.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1")
    contested = stored(classes.join(kinds, "gram"), "contested")
    few = F.col("kinds") <= settings.surroundings
    partial = _sorted_suffixes(_regions(contested.where(few), texts, settings), settings)
    if not contested.where(~few).isEmpty():
        partial = partial.unionByName(
            _counted_windows(_regions(contested.where(~few), texts, settings), settings)
        )
    partial = stored(partial, "matches")

    # All runs of a row agree, so what is found for one holds for each.
    width = F.col("last") - F.col("first")
    span = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    whole = lambda firsts: F.transform(firsts, lambda x: span(x, x + width))
    within = lambda firsts, spans: F.flatten(
        F.transform(firsts, lambda x: F.transform(spans, lambda s: span(x + s["a"], x + s["b"])))
    )
    if keep_first:
        is_first = place.eqNullSafe(F.col("place"))
        head, rest = F.slice("firsts", 1, 1), F.slice("firsts", 2, F.greatest(F.size("firsts") - 1, F.lit(1)))
        earlier = F.coalesce("earlier", F.array().cast(SPANS))
        removed = F.when(~is_first, whole(F.col("firsts"))).otherwise(
            F.concat(within(head, earlier), whole(rest))
        )
    else:
        removed = F.when(F.col("times") > 1, whole(F.col("firsts"))).otherwise(
            within(F.col("firsts"), F.col("any"))
        )
    return (
        candidates.join(classes, ["gram", "region"])
        .join(partial, ["gram", "region"], "left")
        .select(*KEY, removed.alias("spans"))
        .where(F.size("spans") > 0)
        .groupBy(*KEY)
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )


CUT = "k1 BIGINT, k2 BIGINT, copies BIGINT, least_id BIGINT, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept BINARY, kept_sha256 STRING"


def _covered(size: int, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether each byte is covered by a window that starts in one of the intervals."""
    change = np.bincount(a, minlength=size + 1) - np.bincount(b + length, minlength=size + 1)
    return np.cumsum(change[:size]) > 0


def _interval_lists(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and ends of each row of a column of intervals; none for NULL."""
    flat = column.flatten()
    a, b = (flat.field(k).to_numpy() for k in (0, 1))
    cuts = np.cumsum(np.nan_to_num(column.value_lengths().fill_null(0).to_numpy()))[:-1]
    yield from zip(np.split(a, cuts), np.split(b, cuts))


def remove_repeats(
    df: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    settings: Repeats = Repeats(),
    keep_first: bool = True,
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, n_bytes, n_removed, n_spans, kept,
    kept_sha256``.

    Removes the bytes of every string of ``length`` bytes that occurs again: of later
    occurrences only, or of all of them if ``keep_first`` is off. ``kept`` holds the
    bytes that are left.
    """
    texts = distinct_texts(df, text, doc_id)
    length = settings.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                columns = [c.to_pylist() for c in part.columns[:5]]
                spans = _interval_lists(part.column(5))
                for k1, k2, copies, least_id, content, (a, b) in zip(*columns, spans):
                    data = content.encode()
                    covered = _covered(len(data), a, b, length)
                    if copies > 1 and len(data) >= length and not keep_first:
                        covered[:] = True
                    kept = np.frombuffer(data, np.uint8)[~covered].tobytes()
                    n_spans = np.count_nonzero(np.diff(covered.view(np.int8), prepend=0) == 1)
                    n_removed = len(data) - len(kept)
                    digest = sha256(kept).hexdigest()
                    rows.append((k1, k2, copies, least_id, len(data), n_removed, n_spans, kept, digest))
                kinds = [pa.int64()] * 7 + [pa.binary(), pa.string()]
                yield pa.record_batch(
                    [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)],
                    names=[field.split()[0] for field in CUT.split(",")],
                )

    cut = (
        texts.select(*KEY, "copies", "least_id", "text")
        .join(repeated_windows(texts, settings, keep_first), KEY, "left")
        .select(*KEY, "copies", "least_id", "text", "spans")
        .mapInArrow(run, CUT)
    )
    k1, k2 = content_key(F.coalesce(F.col(text), F.lit("")))
    rows = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), k1.alias("k1"), k2.alias("k2"))
    # Of copies that are long enough, only that with the smallest id is not a repetition.
    copy = (
        F.lit(keep_first)
        & (F.col("copies") > 1)
        & (F.col("n_bytes") >= length)
        & ~F.col("doc_id").eqNullSafe(F.col("least_id"))
    )
    nothing = F.lit("").cast("binary")
    return rows.join(cut, KEY).select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.col("n_spans")).cast("bigint").alias("n_spans"),
        F.when(copy, nothing).otherwise(F.col("kept")).alias("kept"),
        F.when(copy, F.sha2(nothing, 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )
