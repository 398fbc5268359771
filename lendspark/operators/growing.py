"""Random forests of all folds of a search, grown together level by level.

Features are cut into bins once, at values that a sample suggests, as Spark does. One pass
over the rows then gives the counts of a whole level: per tree, node, drawn feature, bin and
label. They are added up and the best splits chosen tree by tree, by the tasks that gather
them; the driver is sent splits only. So there are as many passes as levels, whatever the grid.

A tree's draws follow from the seed and its number: a Poisson number for each copy
of a row of its fold (in 65536ths), features for each node, the same in all folds as in fits that
start from one seed. They do not depend on how small a node may be, so a
tree stands for all such settings until the first split that one of them forbids.

Otherwise trees are Spark's: least Gini impurity, the square root of the number of features
per node, nodes of one label are leaves, leaves side by side that vote alike are one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.operators.blocks import feature_blocks, gathered, opened
from lendspark.operators.held_out import held_out_areas

#: Nodes of a level, and bins, are numbered within these.
DEEPEST, MOST_BINS = 10, 127
BINNED = "key BIGINT, bins BINARY, label BINARY, held BINARY"
BINNED_ROWS = 1 << 15
SAMPLED_ROWS = 1 << 15
DRAWS, TABLED = 1 << 16, 32


def split_points(values: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins - 1`` values between those given, which cut them evenly."""
    if ((values == 0) | (values == 1)).all():
        return np.array([0.5])  # a flag, even if the sample has it nowhere
    distinct, counts = np.unique(values, return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2
    if len(middles) < bins:
        return middles
    before = np.cumsum(counts)[:-1]
    wanted = len(values) / bins * np.arange(1, bins)
    after = np.clip(np.searchsorted(before, wanted), 1, len(before) - 1)
    nearest = after - (wanted - before[after - 1] < before[after] - wanted)
    return middles[np.unique(nearest)]


def sampled_splits(df: DataFrame, rows: int, bins: int) -> list[np.ndarray]:
    """Split points per feature, from rows spread over all of ``df``."""
    step = max(1, rows // SAMPLED_ROWS)
    sample = (
        df.where(F.monotonically_increasing_id() % step == 0).select(vector_to_array("features").alias("x")).toArrow()
    )
    x = sample.column("x").combine_chunks().flatten().to_numpy().reshape(sample.num_rows, -1)
    return [split_points(column, bins) for column in x.T]


def binned_blocks(blocks: DataFrame, splits: Sequence[np.ndarray], folds: int) -> DataFrame:
    """Feature blocks as blocks of twice the number of each feature's bin, feature by feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, gathered, size = TaskContext.get().partitionId() << 32, [], 0

        def batch() -> pa.RecordBatch:
            bins, label, held = (np.concatenate(parts, axis=-1) for parts in zip(*gathered))
            values = [v.tobytes() for v in (bins, label, held)]
            columns = [pa.array([number]), *[pa.array([v], pa.binary()) for v in values]]
            return pa.record_batch(columns, names=["key", "bins", "label", "held"])

        for flags, bits, numbers, label, held in opened(batches, folds):
            bins = np.empty((len(flags), len(label)), np.uint8)
            for k, column in zip(np.flatnonzero(flags), bits):
                bins[k] = np.searchsorted(splits[k], [0.0, 1.0])[column]
            for k, column in zip(np.flatnonzero(~flags), numbers):
                bins[k] = np.searchsorted(splits[k], column)
            gathered.append((2 * bins, (label == 1.0).astype(np.uint8), held.astype(np.int32)))
            size += len(label)
            if size >= BINNED_ROWS:
                yield batch()
                number, gathered, size = number + 1, [], 0
        if gathered:
            yield batch()

    return blocks.mapInArrow(run, BINNED)


def _binned(batches: Iterator[pa.RecordBatch], folds: int) -> Iterator[tuple]:
    for batch in batches:
        for key, bins, label, held in zip(*[c.to_pylist() for c in batch.columns]):
            label = np.frombuffer(label, np.uint8)
            yield (
                key,
                np.frombuffer(bins, np.uint8).reshape(-1, len(label)),
                label,
                np.frombuffer(held, np.int32).reshape(folds, len(label)),
            )


def _poisson_table() -> np.ndarray:
    """Poisson numbers with means 0 to ``TABLED`` for each of the evenly spaced draws."""
    place = (np.arange(DRAWS) + 0.5) / DRAWS
    numbers = np.arange(1, 4 * TABLED + 40)
    logs = np.concatenate([[0.0], np.cumsum(np.log(numbers))])
    table = np.zeros((TABLED + 1, DRAWS), np.uint8)
    for mean in range(1, TABLED + 1):
        chances = np.exp(np.arange(len(logs)) * np.log(mean) - mean - logs)
        table[mean] = np.searchsorted(np.cumsum(chances), place)
    return table


def _bag(table: np.ndarray, seed: Sequence[int], copies: np.ndarray) -> np.ndarray:
    """How often a tree takes each row: a Poisson number for each of its copies, added up."""
    draw = np.random.Generator(np.random.SFC64(seed))
    taken = table[np.minimum(copies, TABLED), draw.integers(0, DRAWS, len(copies), np.uint16)]
    many = copies > TABLED
    if many.any():
        taken = taken.astype(np.int64)
        taken[many] = draw.poisson(copies[many])
    return taken


@dataclass(frozen=True)
class Tree:
    """A tree of a fold, for all ``leasts`` (rows a node must have) that it is the same for.

    Nodes lie level by level. ``feature`` is -1 where nothing splits, ``cut`` twice the last
    bin that goes left, and ``counts`` the rows per label, -1 where there is no node.
    """

    fold: int
    number: int
    leasts: tuple[int, ...]
    feature: np.ndarray
    cut: np.ndarray
    counts: np.ndarray
    open: np.ndarray = field(default_factory=lambda: np.zeros(1, int))  # nodes of the next level to split

    def route(self, bins: np.ndarray, rows: np.ndarray, place: np.ndarray, levels: range) -> np.ndarray:
        """Where ``rows`` are after ``levels``, from their ``place`` in the first of them."""
        flat, width = bins.ravel(), bins.shape[1]
        for level in levels:
            node = place + ((1 << level) - 1)
            value = flat[np.maximum(self.feature, 0)[node] * width + rows]
            place = 2 * place + (value > self.cut[node])
        return place


def drawn_features(seed: int, tree: Tree, level: int, width: int, number: int) -> np.ndarray:
    """The features that each open node of ``tree`` may split by, a row per node."""
    return np.array(
        [
            np.random.Generator(np.random.SFC64([seed, tree.number, level, int(node)])).choice(
                width, number, replace=False
            )
            for node in tree.open
        ]
    )


def _level_counts(grown: Sequence[Tree], drawn: Sequence[np.ndarray], level: int, folds: int, seed: int, bins: int):
    """Counts of the open nodes of all trees: feature drawn, node, bin, label."""
    cells = 2 * bins
    table = _poisson_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((d.shape[1], len(d) * cells)) for d in drawn]
        index = []
        for tree in grown:
            index.append(np.full(1 << level, -1))
            index[-1][tree.open] = np.arange(len(tree.open))
        for key, block, label, held in _binned(batches, folds):
            flat, width = block.ravel(), block.shape[1]
            total, bag = held.sum(axis=0), (None, None)
            for k, tree in enumerate(grown):
                own = (tree.fold, tree.number)
                if bag[0] != own:
                    taken = _bag(table, [seed, *own, key], total - held[tree.fold])
                    rows = np.flatnonzero(taken)
                    bag = (own, rows, taken[rows].astype(float), label[rows])
                _, rows, taken, ones = bag
                node = index[k][tree.route(block, rows, np.zeros(len(rows), int), range(level))]
                inside = node >= 0
                if not inside.all():
                    rows, taken, ones, node = rows[inside], taken[inside], ones[inside], node[inside]
                base = node * cells + ones
                for own, starts in zip(sums[k], (drawn[k] * width).T):
                    cell = flat.take(starts.take(node) + rows)
                    own += np.bincount(base + cell, taken, len(own))
        yield pa.record_batch(
            [pa.array(range(len(grown)), pa.int32()), pa.array([s.astype(np.int64).tobytes() for s in sums], pa.binary())],
            names=["tree", "counts"],
        )

    return run


def best_splits(counts: np.ndarray, least: int) -> np.ndarray:
    """Per node: which of its features (-1 for none), the last bin that goes left, and the
    rows per label on either side. ``counts`` has feature, node, bin and label."""
    left = np.cumsum(counts, axis=2)[:, :, :-1]
    whole = counts.sum(axis=2, keepdims=True)
    right = whole - left
    sizes = [part.sum(axis=3) for part in (left, right, whole)]

    def gini(part: np.ndarray, size: np.ndarray) -> np.ndarray:
        share = part / np.maximum(size, 1)[..., None]
        return 1.0 - (share * share).sum(axis=3)

    below = sum(gini(part, size) * (size / np.maximum(sizes[2], 1)) for part, size in zip((left, right), sizes))
    gain = gini(whole, sizes[2]) - below
    gain[(sizes[0] < least) | (sizes[1] < least)] = 0.0
    by_node = gain.transpose(1, 0, 2)
    best = by_node.reshape(len(by_node), -1).argmax(axis=1)
    feature, cut = np.divmod(best, gain.shape[2])
    nodes = np.arange(len(best))
    feature_or_none = np.where(gain[feature, nodes, cut] > 0, feature, -1)
    return np.column_stack([feature_or_none, cut, left[feature, nodes, cut], right[feature, nodes, cut]])


def _chosen(shapes: Sequence[tuple[int, int]], leasts: Sequence[Sequence[int]], bins: int):
    """Best splits of each tree and least number of rows, from sorted counts of all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(tree: int, total: np.ndarray) -> pa.RecordBatch:
            nodes, number = shapes[tree]
            counts = total.reshape(number, nodes, bins, 2)
            splits = np.stack([best_splits(counts, least) for least in leasts[tree]])
            return pa.record_batch(
                [pa.array([tree], pa.int32()), pa.array([splits.astype(np.int64).tobytes()], pa.binary())],
                names=["tree", "splits"],
            )

        current, total = None, None
        for batch in batches:
            for tree, counts in zip(*[c.to_pylist() for c in batch.columns]):
                if tree != current:
                    if current is not None:
                        yield found(current, total)
                    current, total = tree, np.zeros(len(counts) // 8, np.int64)
                total += np.frombuffer(counts, np.int64)
        if current is not None:
            yield found(current, total)

    return run


def _split(tree: Tree, drawn: np.ndarray, splits: np.ndarray, level: int, last: bool) -> Tree:
    """``tree`` with the ``splits`` of its open nodes."""
    feature, cut, counts = tree.feature.copy(), tree.cut.copy(), tree.counts.copy()
    following = []
    for place, features, (chosen, at, *sides) in zip(tree.open, drawn, splits):
        if chosen < 0:
            continue
        node = (1 << level) - 1 + place
        feature[node], cut[node] = features[chosen], 2 * at
        for child, rows in ((2 * place, sides[:2]), (2 * place + 1, sides[2:])):
            counts[(2 << level) - 1 + child] = rows
            if not last and min(rows) > 0:
                following.append(child)
    return replace(tree, feature=feature, cut=cut, counts=counts, open=np.array(following, int))


def grow(
    blocks: DataFrame, folds: int, numbers: int, depth: int, leasts: Sequence[int], widths: Sequence[int], seed: int
) -> list[Tree]:
    """``numbers`` trees of ``depth`` per fold and least number of rows of a node.

    ``widths`` are the numbers of bins of the features.
    """
    nodes, bins = (2 << depth) - 1, max(widths)
    per_node = len(widths) if numbers == 1 else int(np.ceil(np.sqrt(len(widths))))
    grown = [
        Tree(fold, k, tuple(leasts), np.full(nodes, -1), np.full(nodes, 255, np.uint8), np.full((nodes, 2), -1))
        for fold in range(folds)
        for k in range(numbers)
    ]
    for level in range(depth):
        growing = [tree for tree in grown if len(tree.open)]
        if not growing:
            break
        drawn = [drawn_features(seed, tree, level, len(widths), per_node) for tree in growing]
        # One row per tree.
        rows = (
            blocks.mapInArrow(_level_counts(growing, drawn, level, folds, seed, bins), "tree INT, counts BINARY")
            .repartition(len(growing), "tree")
            .sortWithinPartitions("tree")
            .mapInArrow(_chosen([d.shape for d in drawn], [t.leasts for t in growing], bins), "tree INT, splits BINARY")
            .collect()
        )
        done = [tree for tree in grown if not len(tree.open)]
        for row in rows:
            tree, features = growing[row["tree"]], drawn[row["tree"]]
            splits = np.frombuffer(row["splits"], np.int64).reshape(len(tree.leasts), len(tree.open), 6)
            if level == 0:
                root = splits[0, 0, 2:].reshape(2, 2).sum(axis=0)
                tree = replace(tree, counts=np.concatenate([root[None], tree.counts[1:]]))
            same: dict[bytes, list[int]] = {}
            for k, own in enumerate(splits):
                same.setdefault(np.where(own[:, :1] < 0, -1, own).tobytes(), []).append(k)
            for members in same.values():
                part = replace(tree, leasts=tuple(tree.leasts[k] for k in members))
                done.append(_split(part, features, splits[members[0]], level, level + 1 == depth))
        grown = sorted(done, key=lambda tree: (tree.fold, tree.number, tree.leasts))
    return grown


def shares(tree: Tree, depth: int) -> np.ndarray:
    """The share of the positive class for each place of a level where rows end that are
    routed through the tree cut there."""
    total = tree.counts.sum(axis=1)
    share = np.where(total > 0, tree.counts[:, 1] / np.maximum(total, 1), 0.0)
    vote = tree.counts[:, 1] > tree.counts[:, 0]
    leaf = tree.feature < 0
    leaf[(1 << depth) - 1 :] = True
    for node in range((1 << depth) - 2, -1, -1):
        one, two = 2 * node + 1, 2 * node + 2
        leaf[node] |= tree.feature[node] >= 0 and leaf[one] and leaf[two] and vote[one] == vote[two]
    for node in range((1 << depth) - 1):  # parents come before their children
        if leaf[node]:
            share[2 * node + 1] = share[2 * node + 2] = share[node]
            leaf[2 * node + 1] = leaf[2 * node + 2] = True
    return share[(1 << depth) - 1 : (2 << depth) - 1]


def forest_scores(grown: Sequence[Tree], folds: int, settings: Sequence[tuple[int, int, int]]):
    """Scores of the rows of binned blocks, a column for each ``(trees, depth, least)``."""
    depths = sorted({depth for _, depth, _ in settings})
    leasts = sorted({least for _, _, least in settings})
    tables = [{depth: shares(tree, depth) for depth in depths} for tree in grown]

    def scores(batches: Iterator[pa.RecordBatch], step: int):
        for _, block, label, held in _binned(batches, folds):
            for fold in range(folds):
                rows = np.flatnonzero(held[fold])
                rows = rows[rows % step == 0]
                if not len(rows):
                    continue
                found = np.zeros((len(rows), len(settings)))
                totals = {(depth, least): np.zeros(len(rows)) for depth in depths for least in leasts}
                own = [k for k, tree in enumerate(grown) if tree.fold == fold]
                for number in range(max(grown[k].number for k in own) + 1):
                    for k in own:
                        tree, place, level = grown[k], np.zeros(len(rows), int), 0
                        if tree.number != number:
                            continue
                        for depth in depths:
                            place, level = tree.route(block, rows, place, range(level, depth)), depth
                            share = tables[k][depth][place]
                            for least in tree.leasts:
                                totals[(depth, least)] += share
                    for column, (trees, depth, least) in enumerate(settings):
                        if trees == number + 1:
                            found[:, column] = totals[(depth, least)]
                yield fold, found, label[rows].astype(float), held[fold, rows]

    return scores


def fold_metrics(
    df: DataFrame, folds: int, settings: Sequence[tuple[int, int, int]], metric: str, estimator: Estimator, rows: int
) -> np.ndarray:
    """The metric of each setting ``(trees, depth, least rows of a node)`` in each fold.

    ``df`` has ``features``, ``label`` and ``fold`` of ``rows`` rows.
    """
    splits = sampled_splits(df, rows, estimator.getMaxBins())
    blocks = binned_blocks(gathered(feature_blocks(df)), splits, folds).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        most, deepest = (max(setting[k] for setting in settings) for k in (0, 1))
        leasts = sorted({least for _, _, least in settings})
        widths = [len(points) + 1 for points in splits]
        # Numbers that draws start from are not negative.
        grown = grow(blocks, folds, most, deepest, leasts, widths, estimator.getSeed() % (1 << 63))
        scores = forest_scores(grown, folds, settings)
        return held_out_areas(blocks, scores, folds, len(settings), rows, metric)
    finally:
        blocks.unpersist()
