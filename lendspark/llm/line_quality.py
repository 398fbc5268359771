"""Quality rules: counts within each document, and lines that many documents share.

Method: cross-document line frequency. Normalised lines are hashed, and the distinct
documents with a line are counted per host. Lines above the host's limit are removed, and
a document of which too little remains is rejected. Verdicts give counts and leave the
text as it is; ``keep_good`` gives what is left of it. Everything is made of column
functions, aggregates and joins.

Defined cases: a NULL text is an empty one and fails the base rules. Rows without a host
are one host of their own. Documents of a host that have the same text count once, and
get the same verdict; that departs from counting documents one by one. Other columns of the
input, whatever their names, are neither read nor changed. Empty lines
are never frequent.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.llm.common import BLANKS, content_key, stored, without, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
INNER_BLANKS = r"[\x20\x09\x0B-\x0D]+"
KEY = ["_host", "_k1", "_k2"]


@dataclass(frozen=True)
class Limits:
    """Bounds of the rules.

    A line is removed if more than ``line_share`` of the host's distinct documents, and
    more than ``line_documents`` of them, have it; and if more than ``most_documents`` have
    it, whatever their share. A document is depleted if less than ``left_share`` of the words
    in its distinct lines are left.
    """

    min_words: int = 20
    repeat_percent: int = 30
    line_documents: int = 20
    line_share: float = 0.02
    most_documents: int | None = None
    left_share: float = 0.3


def _has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS)) != ""


def base_counts(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the counts of the rules that need one document alone.

    Words are found once per row; the windows of a text are compared by 64-bit hashes,
    and are only sorted if two of them agree.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    window = F.transform(
        F.sequence(F.lit(0), F.size("_hashes") - WINDOW),
        lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)]),
    )
    neighbour = lambda p, i: F.coalesce(F.get("_sorted", i)["h"] == p["h"], F.lit(False))
    repeated = F.filter("_sorted", lambda p, i: neighbour(p, i - 1) | neighbour(p, i + 1))
    gaps = F.transform(
        "_starts",
        lambda start, i: F.coalesce(
            F.least(F.lit(WINDOW), F.get("_starts", i + 1) - start), F.lit(WINDOW)
        ),
    )
    with_word = F.filter(F.split(content, "\n"), _has_word)
    return (
        df.withColumns(
            {
                "_words": words(content),
                "_lines": with_word,
                "_chars": F.char_length(content),
                "_plain": F.char_length(without(content, SYMBOLS)),
            }
        )
        .withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
        .withColumn(
            "_windows",
            F.when(F.size("_hashes") >= WINDOW, window).otherwise(
                F.array().cast("array<bigint>")
            ),
        )
        .withColumn(
            "_sorted",
            F.when(
                F.size(F.array_distinct("_windows")) < F.size("_windows"),
                F.sort_array(
                    F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
                ),
            ),
        )
        .withColumn("_starts", F.sort_array(F.transform(repeated, lambda p: p["i"])))
        .withColumns(
            {
                "n_words": F.size("_words").cast("bigint"),
                "word_chars": F.char_length(F.array_join("_words", "")).cast("bigint"),
                "n_symbols": (F.col("_chars") - F.col("_plain")).cast("bigint"),
                "n_dup_lines": (
                    F.size("_lines") - F.size(F.array_distinct("_lines"))
                ).cast("bigint"),
                "n_repeat_words": F.coalesce(
                    F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap), F.lit(0)
                ).cast("bigint"),
            }
        )
        .drop("_words", "_hashes", "_windows", "_sorted", "_starts")
        .drop("_lines", "_chars", "_plain")
    )


def _normal_lines(content: Column) -> Column:
    """The lines of a text in lower case, blanks squeezed, digits made equal."""
    digits = F.translate(F.lower(content), "123456789", "0" * 9)
    normal = F.split(F.regexp_replace(digits, INNER_BLANKS, " "), "\n")
    return F.transform(normal, lambda x: F.trim(x))


def line_hashes(df: DataFrame, text: str, host: str) -> DataFrame:
    """One row per host, text and distinct normalised line, with the words of the line."""
    content = F.coalesce(F.col(text), F.lit(""))
    lines = F.array_remove(_normal_lines(content), "")
    gaps = lambda x: F.length(x) - F.length(without(x, " "))
    line = lambda x: F.struct(F.xxhash64(x).alias("line"), (gaps(x) + 1).alias("w"))
    k1, k2 = content_key(content)
    return (
        df.select(
            F.coalesce(F.col(host), F.lit("")).alias("_host"),
            k1.alias("_k1"),
            k2.alias("_k2"),
            F.explode(F.transform(F.array_distinct(lines), line)).alias("_line"),
        )
        .groupBy(*KEY, F.col("_line.line").alias("_hash"))
        .agg(F.max("_line.w").cast("bigint").alias("_w"))
    )


def frequent_lines(lines: DataFrame, limits: Limits) -> DataFrame:
    """``(_host, _hash)`` of the lines above their host's limit."""
    sizes = lines.select(*KEY).distinct().groupBy("_host").agg(F.count("*").alias("_texts"))
    counts = lines.groupBy("_host", "_hash").agg(F.count("*").alias("_documents"))
    limit = F.greatest(F.lit(limits.line_documents), F.col("_texts") * limits.line_share)
    if limits.most_documents is not None:
        limit = F.least(limit, F.lit(limits.most_documents))
    return (
        counts.where(F.col("_documents") > min(limits.line_documents, limits.most_documents or limits.line_documents))
        .join(sizes, "_host")
        .where(F.col("_documents") > limit)
        .select("_host", "_hash")
    )


def left_words(df: DataFrame, text: str, host: str, limits: Limits) -> DataFrame:
    """Per host and text that has a frequent line: words in distinct lines, those left, and
    the hashes of its frequent lines."""
    lines = stored(line_hashes(df, text, host), "lines")
    marked = frequent_lines(lines, limits).withColumn("_often", F.lit(True))
    words_left = F.sum(F.when(F.col("_often").isNull(), F.col("_w")).otherwise(0))
    return (
        lines.join(marked, ["_host", "_hash"], "left")
        .groupBy(*KEY)
        .agg(
            F.sum("_w").alias("_all"),
            words_left.alias("_left"),
            F.sort_array(F.collect_list(F.when(F.col("_often"), F.col("_hash")))).alias("_gone"),
        )
        .where("_left < _all")
    )


def _judged(df: DataFrame, text: str, host: str, limits: Limits) -> DataFrame:
    """``df`` with the columns of ``with_verdict``, and ``_gone``."""
    k1, k2 = content_key(F.coalesce(F.col(text), F.lit("")))
    keyed = df.withColumns(
        {"_host": F.coalesce(F.col(host), F.lit("")), "_k1": k1, "_k2": k2}
    )
    failed = (F.col("n_words") < limits.min_words) | (
        F.lit(100) * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words")
    )
    enough = F.col("_left") >= limits.left_share * F.col("_all")
    return (
        base_counts(keyed, text)
        .withColumn("base_failed", failed)
        .join(left_words(df, text, host, limits), KEY, "left")
        .withColumns(
            {
                "words_left": F.col("_left"),
                "kept": F.when(F.col("base_failed"), F.lit(False)).otherwise(
                    F.coalesce(enough, F.lit(True))
                ),
            }
        )
        .drop(*KEY, "_all", "_left")
    )


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
VERDICT = [*COUNTS, "base_failed", "words_left", "kept"]


def _renamed(df: DataFrame) -> DataFrame:
    """``df`` with names that none of the columns made here has."""
    return df.select(*[F.col(f"`{name}`").alias(f"_in_{name}") for name in df.columns])


def with_verdict(
    df: DataFrame, text: str = "text", host: str = "source", limits: Limits = Limits()
) -> DataFrame:
    """``df`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``words_left`` and ``kept``.

    Columns of these names in ``df`` are replaced. ``words_left`` counts distinct lines;
    it is NULL where no line was removed.
    """
    judged = _judged(_renamed(df), f"_in_{text}", f"_in_{host}", limits)
    inputs = [F.col(f"`_in_{name}`").alias(name) for name in df.columns if name not in VERDICT]
    return judged.select(*inputs, *VERDICT)


# Steps of a search in a sorted array of any size that an array may have.
HALVES = [1 << k for k in range(30, -1, -1)]


def _among(hashes: Column, wanted: Column) -> Column:
    """Whether ``wanted`` is among the sorted ``hashes``, by halving."""
    upto = F.aggregate(
        F.array(*map(F.lit, HALVES)),
        F.lit(0),
        lambda at, step: F.when(
            (step <= F.size(hashes) - at) & (F.get(hashes, at + step - 1) <= wanted), at + step
        ).otherwise(at),
    )
    return F.coalesce(F.get(hashes, upto - 1) == wanted, F.lit(False))


def _without_frequent(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the lines of ``_gone`` taken out of the texts that have any.

    Every line is hashed once, and stands beside its hash while it is looked up.
    """
    lines = F.arrays_zip(
        F.split(F.col(text), "\n").alias("line"), _normal_lines(F.col(text)).alias("normal")
    )
    hashed = F.transform(lines, lambda x: F.struct(x["line"].alias("line"), F.xxhash64(x["normal"]).alias("hash")))
    stays = F.filter(hashed, lambda x: ~_among(F.col("_gone"), x["hash"]))
    rest = F.array_join(F.transform(stays, lambda x: x["line"]), "\n")
    return df.withColumn(text, F.when(F.col("_gone").isNotNull(), rest).otherwise(F.col(text))).drop("_gone")


def keep_good(
    df: DataFrame, text: str = "text", host: str = "source", limits: Limits = Limits()
) -> DataFrame:
    """The rows of ``df`` that pass, with the columns of ``df``; frequent lines are removed
    from the text."""
    judged = _judged(_renamed(df), f"_in_{text}", f"_in_{host}", limits).where("kept")
    return _without_frequent(judged, f"_in_{text}").select(
        *[F.col(f"`_in_{name}`").alias(name) for name in df.columns]
    )
