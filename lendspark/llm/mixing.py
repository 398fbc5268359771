"""Documents drawn from a tree of sources so that token shares meet target weights.

Method: hierarchical budgeting. The token budget is handed down the tree by the weights
of siblings. What a node cannot supply goes to its siblings in proportion to their
weights, and only what all of them cannot supply goes up to the siblings of the parent.
A leaf supplies its documents in seeded epochs, each in its own random order, and the
prefix of the last epoch that the budget still covers.

Leaves are few rows by the time budgets are worked out. The prefix of a leaf is found
from sums per range of the random order; rows are sorted only within the one range where
the budget ends, so a leaf may hold any share of all rows.

Defined cases: a NULL in a level is a child of its own, the same as an empty name. A
NULL text has no tokens; such documents are in every full epoch, and in a prefix like
others. Rows that agree in id and text are taken or left together. If the budget exceeds
what all leaves can supply, everything is supplied. A weight of zero takes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendspark.llm.common import stored, words

RANGE_BITS = 10


@dataclass(frozen=True)
class Mix:
    """Targets. ``weights`` maps paths from the root to weights relative to siblings.

    ``None`` in a path stands for any name; a later entry overrides an earlier one; nodes
    without an entry weigh 1. ``share`` is the budget as a part of all tokens there are,
    and ``max_epochs`` how often a document may be used.
    """

    weights: Mapping[Sequence[str | None], float] = field(default_factory=dict)
    share: float = 1.0
    max_epochs: int = 4
    seed: int = 42


def _names(depth: int) -> list[str]:
    return [f"_level{k}" for k in range(depth)]


def _weight(depth: int, mix: Mix) -> Column:
    weight = F.lit(1.0)
    for path, value in mix.weights.items():
        if len(path) == depth:
            fits = F.lit(True)
            for name, wanted in zip(_names(depth), path):
                if wanted is not None:
                    fits = fits & (F.col(name) == wanted)
            weight = F.when(fits, F.lit(float(value))).otherwise(weight)
    return weight


def leaf_budgets(leaves: DataFrame, depth: int, mix: Mix) -> DataFrame:
    """``leaves`` (levels and ``tokens``) with the ``budget`` of each."""
    usable = F.lit(True)
    for d in range(1, depth + 1):
        usable = usable & (_weight(d, mix) > 0)
    nodes = leaves.withColumn(
        "_cap", F.when(usable, F.col("tokens") * float(mix.max_epochs)).otherwise(0.0)
    )
    everything = Window.partitionBy(F.lit(1))
    # Levels as one row per leaf; the values of a node repeat on its leaves.
    nodes = nodes.withColumn(
        "budget",
        F.least(F.sum("tokens").over(everything) * mix.share, F.sum("_cap").over(everything)),
    )
    for d in range(1, depth + 1):
        parent, own = _names(d - 1), _names(d)
        level = nodes.groupBy(*own).agg(
            F.sum("_cap").alias("_c"), F.first("budget").alias("_b")
        ).withColumn("_w", _weight(d, mix))
        by_need = Window.partitionBy(*parent or [F.lit(1)]).orderBy(
            (F.col("_c") / F.nullif(F.col("_w"), F.lit(0.0))).asc_nulls_first(), *own
        )
        before = by_need.rowsBetween(Window.unboundedPreceding, -1)
        after = by_need.rowsBetween(0, Window.unboundedFollowing)
        siblings = Window.partitionBy(*parent or [F.lit(1)])
        level = (
            level.withColumn("_rest", F.col("_b") - F.coalesce(F.sum("_c").over(before), F.lit(0.0)))
            .withColumn("_fair", F.col("_rest") / F.nullif(F.sum("_w").over(after), F.lit(0.0)))
            .withColumn("_full", F.coalesce(F.col("_w") * F.col("_fair") >= F.col("_c"), F.lit(True)))
            # The first node that is not used up has the largest fair share of those that are not.
            .withColumn("_level", F.max(F.when(~F.col("_full"), F.col("_fair"))).over(siblings))
            .select(
                *own,
                F.when(F.col("_full"), F.col("_c"))
                .otherwise(F.least("_c", F.col("_w") * F.col("_level")))
                .alias("_share"),
            )
        )
        nodes = nodes.join(level, own).withColumn("budget", F.col("_share")).drop("_share")
    return nodes.drop("_cap")


def _order(epoch: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), epoch, F.col("_id"), F.col("_text_key"))


def _range(order: Column) -> Column:
    return F.shiftright(order, 64 - RANGE_BITS)


def mix_sources(
    df: DataFrame,
    levels: Sequence[Column],
    mix: Mix,
    text: str = "text",
    doc_id: str = "doc_id",
    tokens: Column | None = None,
) -> DataFrame:
    """The columns of ``df`` in a struct ``row``, once per use, with ``epoch`` and ``order``.

    ``order`` sorts the documents of an epoch within their leaf. ``tokens`` measures a
    document; the default is its number of words.
    """
    names = _names(len(levels))
    content = F.coalesce(F.col(text), F.lit(""))
    size = F.size(words(content)) if tokens is None else tokens
    keyed = df.select(
        F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("row"),
        *[F.coalesce(level, F.lit("")).alias(name) for level, name in zip(levels, names)],
        F.col(doc_id).alias("_id"),
        F.xxhash64(content).alias("_text_key"),
        size.cast("bigint").alias("_tokens"),
    )
    small = stored(keyed.drop("row"), "sizes")
    leaves = small.groupBy(*names).agg(F.sum("_tokens").alias("tokens"))
    epochs = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(
        F.when(F.col("budget").isNotNull(), F.lit(1))
    )
    budgets = stored(
        leaf_budgets(leaves, len(names), mix)
        .withColumn("full", epochs.cast("int"))
        .withColumn("rest", F.col("budget") - F.col("full") * F.col("tokens"))
        .select(*names, "full", "rest"),
        "budgets",
    )

    order = _order(F.col("full"), mix.seed)
    placed = small.join(budgets, names).select(
        *names, "rest", "_tokens", order.alias("_order"), _range(order).alias("_range")
    )
    so_far = Window.partitionBy(*names).orderBy("_range")
    last = Window.partitionBy(*names)
    ends = (
        placed.groupBy(*names, "rest", "_range")
        .agg(F.sum("_tokens").alias("_sum"))
        .withColumn("_end", F.sum("_sum").over(so_far))
        .where("_end > rest")
        .withColumn("_first", F.min("_range").over(last))
        .where("_range = _first")
        .select(*names, "_range", (F.col("_end") - F.col("_sum")).alias("_start"))
    )
    within = Window.partitionBy(*names).orderBy("_order")
    cuts = (
        placed.join(ends, [*names, "_range"])
        .withColumn("_total", F.col("_start") + F.sum("_tokens").over(within))
        .groupBy(*names)
        .agg(F.min(F.when(F.col("_total") > F.col("rest"), F.col("_order"))).alias("_cut"))
    )
    plan = stored(budgets.join(cuts, names, "left"), "plan")
    # No cut means that the whole leaf fits in what is left, or that it has no tokens.
    partial = F.coalesce(order < F.col("_cut"), F.lit(False)).cast("int")
    return (
        keyed.drop("_tokens")
        .join(plan, names)
        .withColumn("_uses", F.col("full") + partial)
        .where("_uses > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_uses") - 1)))
        .select("row", *names, "epoch", _order(F.col("epoch"), mix.seed).alias("order"))
    )
