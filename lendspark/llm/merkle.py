"""A manifest of a dataset as a hash tree, with a proof for every row.

Method: pointer-jumping proofs. Rows are leaves, in the order of their key within their
group; two consecutive nodes become one, a node without a partner becomes one alone, until
a group has one node, its subroot. Subroots in the order of their groups are the leaves of
one more tree, which gives the root. Every node holds the siblings on the way towards an
ancestor, at first its own sibling alone. A self-join appends the segment of that ancestor
to it, which doubles the distance; it is repeated until every leaf reaches its root. A
round needs only the nodes whose level is a multiple of the distance, so all but the
leaves soon fall away.

Rows are brought into order by key ranges and counted per range, so no group and no tree is
in one task. Nodes are made from blocks of ``2 ** block_levels`` neighbours; all nodes at
a block's top go into the next pass. Every pass and round is stored in the shared folder.

Defined cases: a NULL field is hashed as ``-``. A NULL group is a group of its own and the
first. Rows without a key come first in their group; rows that share a key are ordered by
their hash, and those that agree in it too are interchangeable, but each has a place of its
own. A group of one row has that leaf as its subroot and an empty proof there. No rows give
no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendspark.llm.common import stored

DIGEST = 32
BLOCK_LEVELS = 10
# What a tree keeps of a row: a node beside the way, a node that goes up, a tree's last node.
STEP, UP, TOP = 0, 1, 2
# Rows of subroots that are broadcast; beyond that they are joined by group and salt.
BROADCAST_BYTES = 8 << 20
SALTS = 64


def leaf_digest(fields: Sequence[Column]) -> Column:
    """The hash of the fields: each ``-`` if NULL, else its length in bytes, ``:``, its text."""
    texts = [field.cast("string") for field in fields]
    parts = [
        F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        for text in texts
    ]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def join_digests(*digests: bytes) -> bytes:
    """The hash of digests, taken as lower-case hexadecimal text."""
    return hashlib.sha256("".join([d.hex() for d in digests]).encode()).digest()


def placed(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``index``, the place of a row within its ``group``, and the group's ``size``.

    ``order`` sorts the rows of a group. Rows are numbered within ranges of group and
    order; what comes before a range follows from one row per range and group.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("range", T.IntegerType()), T.StructField("at", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([task] * rows, pa.int32()), pa.array(range(done, done + rows), pa.int64())],
                names=schema.names,
            )
            done += rows

    keys = ["group", *order]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = stored(dealt.mapInArrow(number, schema), name)
    before = Window.partitionBy("group").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        rows.groupBy("group", "range")
        .agg(F.min("at").alias("first"), F.count("*").alias("n"))
        .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first"))
        .withColumn("size", F.sum("n").over(Window.partitionBy("group")))
        .select("group", "range", "start", "size")
    )
    return (
        rows.join(ranges, ["group", "range"])
        .withColumn("index", F.col("at") + F.col("start"))
        .drop("range", "at", "start")
    )


NODE = "group BINARY, kind INT, level INT, index BIGINT, size BIGINT, digest BINARY, segment BINARY"


def _levels(digests: list[bytes], first: int, size: int, level: int, block_levels: int) -> Iterator[tuple]:
    """``(kind, level, index, size, digest, segment)`` of the nodes over one block.

    ``first`` is the index of the first digest and ``size`` how many the group has on this
    level. The lowest nodes come first, in order.
    """
    for step in range(block_levels + 1):
        if size == 1 or step == block_levels:
            kind = TOP if size == 1 else UP
            if size == 1 and level == step == 0:
                yield STEP, 0, first, size, digests[0], b""
            yield kind, level + step, first, size, digests[0], b""
            return
        pairs = [digests[k : k + 2] for k in range(0, len(digests), 2)]
        for k, pair in enumerate(pairs):
            for side, digest in enumerate(pair):
                beside = pair[1 - side] if len(pair) == 2 else b""
                yield STEP, level + step, first + 2 * k + side, size, digest, beside
        digests, first, size = [join_digests(*pair) for pair in pairs], first >> 1, (size + 1) >> 1


def _pass(nodes: DataFrame, level: int, block_levels: int, carried: Sequence[T.StructField]) -> DataFrame:
    """The nodes over those in ``nodes``, which are on ``level``, block by block.

    The lowest ones keep the ``carried`` columns.
    """
    names = [field.name for field in carried]
    plain = T.StructType.fromDDL(NODE)
    schema = T.StructType([*plain.fields, *carried])

    def made(table: pa.Table) -> Iterator[pa.RecordBatch]:
        """Whole blocks, one after the other."""
        index, size, groups = (table.column(c).to_pylist() for c in ("index", "size", "group"))
        digests = table.column("digest").to_pylist()
        rows, source, at = [], [], 0
        while at < len(index):
            stop = at + 1
            while stop < len(index) and groups[stop] == groups[at] and index[stop] >> block_levels == index[at] >> block_levels:
                stop += 1
            for n, node in enumerate(_levels(digests[at:stop], index[at], size[at], level, block_levels)):
                rows.append((groups[at], *node))
                source.append(at + n if node[0] == STEP and node[1] == level else None)
            at = stop
        kinds = [pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
        taken = [table.column(c).combine_chunks().take(pa.array(source, pa.int64())) for c in names]
        yield pa.RecordBatch.from_arrays([*columns, *taken], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            # The last block may go on in the next batch.
            group, index = held.column("group"), held.column("index").to_numpy()
            cut = held.num_rows - 1
            while cut and index[cut - 1] >> block_levels == index[cut] >> block_levels and group[cut - 1] == group[cut]:
                cut -= 1
            if cut:
                yield from made(held.slice(0, cut))
                held = held.slice(cut).combine_chunks()
        if held is not None and held.num_rows:
            yield from made(held)

    block = F.shiftright("index", block_levels)
    dealt = (
        nodes.withColumn("block", block)
        .repartition("group", "block")
        .sortWithinPartitions("group", "index")
        .select("group", "index", "size", "digest", *names)
    )
    return stored(dealt.mapInArrow(run, schema), f"tree-{level}")


def trees(leaves: DataFrame, carried: Sequence[str], block_levels: int = BLOCK_LEVELS) -> tuple[DataFrame, DataFrame]:
    """The proof of each leaf within its group, and the last node of each group.

    ``leaves`` has ``group, index, size, digest`` and the ``carried`` columns; the first
    result has ``segment`` too, the siblings from the leaf up, the second one ``group,
    digest``.
    """
    kept = [leaves.schema[name] for name in carried]
    largest = leaves.agg(F.max("size")).first()[0] or 0
    depth = max(0, largest - 1).bit_length()
    passes, tops, level = [], [], 0
    nodes = leaves
    while True:
        made = _pass(nodes, level, block_levels, kept)
        passes.append(made.where(F.col("kind") == STEP).drop("kind"))
        tops.append(made.where(F.col("kind") == TOP).select("group", "digest"))
        level += block_levels
        if level >= depth:
            break
        nodes = made.where(F.col("kind") == UP)
    steps, last = passes[0], tops[0]
    for more, ends in zip(passes[1:], tops[1:]):
        steps, last = steps.unionByName(more), last.unionByName(ends)

    half = 1
    while half < depth:
        place = F.col("level") % (2 * half)
        ancestors = steps.where(place == half).select(
            "group",
            (F.col("level") - half).alias("level"),
            F.col("index").alias("ancestor"),
            F.col("segment").alias("more"),
        )
        steps = stored(
            steps.where(place == 0)
            .withColumn("ancestor", F.shiftright("index", half))
            .join(ancestors, ["group", "level", "ancestor"], "left")
            .withColumn("segment", F.concat("segment", F.coalesce("more", F.lit(b""))))
            .drop("ancestor", "more"),
            f"proofs-{2 * half}",
        )
        half *= 2
    return steps.where("level = 0").drop("level"), last


def _with_top(paths: DataFrame, tops: DataFrame) -> DataFrame:
    """``paths`` with what ``tops`` has for their group, a group of any size included."""
    bytes_each = F.octet_length("group") + F.octet_length("top_segment") + 3 * DIGEST
    if (tops.agg(F.sum(bytes_each)).first()[0] or 0) <= BROADCAST_BYTES:
        return paths.join(F.broadcast(tops), "group")
    salted = tops.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod("index", F.lit(SALTS)).cast("int")
    return paths.withColumn("salt", salt).join(salted, ["group", "salt"]).drop("salt")


def manifest(
    df: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    key: str = "doc_id",
    group: str = "lang",
    carry: Mapping[str, Column] | None = None,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """One row per row of ``df`` with its leaf and its proof.

    ``key``; ``leaf``, ``subroot``, ``root`` as bytes; ``proof``, the siblings one after the
    other; and the places that say how to fold them: ``index`` of ``size`` in the group,
    ``top_index`` of ``top_size`` among the groups. ``carry`` names further columns, worked
    out from those of ``df``.
    """
    carry = dict(carry or {})
    name = F.col(group).cast("string")
    # Sorts like the name byte by byte, and NULL before all.
    grouped = F.when(name.isNull(), F.lit(b"")).otherwise(F.concat(F.lit(b"\x01"), name.cast("binary")))
    leaves = stored(
        df.select(
            grouped.alias("group"),
            F.col(key).alias("key"),
            leaf_digest([F.col(field) for field in fields]).alias("digest"),
            F.monotonically_increasing_id().alias("tie"),
            *[column.alias(f"carried_{k}") for k, column in enumerate(carry.values())],
        ),
        "leaves",
    )
    extra = ["key", *[f"carried_{k}" for k in range(len(carry))]]
    paths, subroots = trees(placed(leaves, ["key", "digest", "tie"], "places").drop("tie"), extra, block_levels)

    tops = subroots.select(F.lit(b"").alias("group"), F.col("group").alias("name"), "digest")
    top_paths, root = trees(placed(tops, ["name"], "groups"), ["name"], block_levels)
    tops = (
        top_paths.crossJoin(F.broadcast(root.select(F.col("digest").alias("root"))))
        .select(
            F.col("name").alias("group"),
            F.col("index").alias("top_index"),
            F.col("size").alias("top_size"),
            F.col("segment").alias("top_segment"),
            F.col("digest").alias("subroot"),
            "root",
        )
    )
    return _with_top(paths, stored(tops, "subroots")).select(
        F.col("key").alias(key),
        F.col("digest").alias("leaf"),
        "index",
        "size",
        "top_index",
        "top_size",
        F.concat("segment", "top_segment").alias("proof"),
        "subroot",
        "root",
        *[F.col(f"carried_{k}").alias(name) for k, name in enumerate(carry)],
    )


def fold(leaf: bytes, proof: bytes, places: Sequence[tuple[int, int]]) -> bytes:
    """The root that follows from a leaf, its siblings, and its ``(index, size)`` per tree."""
    at = 0
    for index, size in places:
        while size > 1:
            if index ^ 1 < size:
                beside = proof[at : at + DIGEST]
                at += DIGEST
                leaf = join_digests(beside, leaf) if index & 1 else join_digests(leaf, beside)
            else:
                leaf = join_digests(leaf)
            index, size = index >> 1, (size + 1) >> 1
    return leaf


def verified(rows: DataFrame, leaf: str = "leaf") -> DataFrame:
    """Rows of :func:`manifest` with ``folded_root``, which follows from the column ``leaf``
    and the proof, and ``verified``, whether that is the root."""
    schema = T.StructType([*rows.schema.fields, T.StructField("folded_root", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [batch.column(c).to_pylist() for c in (leaf, "proof", "index", "size", "top_index", "top_size")]
            roots = [fold(x, proof, [(i, n), (j, m)]) for x, proof, i, n, j, m in zip(*values)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(roots, pa.binary())], names=schema.names)

    return rows.mapInArrow(run, schema).withColumn("verified", F.col("folded_root") == F.col("root"))
