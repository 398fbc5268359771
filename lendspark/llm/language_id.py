"""The language of texts.

Method: language-bitmask n-gram filters. The n-grams usual in a language are entered in a
Bloom filter. The filters of all languages are one table, sliced by bit: a slot holds a
bitmask of languages, in as many words as they need, and the masks at the slots of an n-gram, ANDed, are the languages
that may contain it. A text is decided by the number of its n-grams per language, less
the hits expected by chance from how full a language's filter is.

An n-gram is usual if it occurs in a given share of the documents learned from. These are
a sample of bounded expected size per language, drawn by hash; the number of usual
n-grams is then bounded by the n-grams of a document over that share, whatever the size
of the corpus. The table that is sent to the tasks grows with the number of languages
alone. Texts are read whole.

Defined cases: NULL texts and texts without a letter are ``und`` with score 0. If no
n-gram is known, or for ties, the language with more documents wins. Rows without a
language, or whose id is NULL, teach nothing. No rows to learn from: all is ``und``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.llm.shingles import U64, mixed

UNKNOWN = "und"
CHUNK_CHARS = 1 << 19


@dataclass(frozen=True)
class Learning:
    """Settings. ``documents`` bounds the sample per language; ``share`` of them must have
    an n-gram for it to be usual, and two at least unless the language has less than
    ``few``."""

    size: int = 4
    documents: int = 20_000
    share: float = 0.005
    few: int = 20
    slots_per_gram: int = 16
    seed: int = 42


@dataclass(frozen=True)
class Filters:
    """``table[slot]`` is a bitmask of one or more words; ``by_chance`` is each language's rate of false hits."""

    languages: list[str]
    table: np.ndarray
    by_chance: np.ndarray
    size: int


_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool))
    return _LETTERS[0]


def grams(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all texts in turn, where each text's begin, and how many
    letters it has. Case is folded, and whatever lies between words is one boundary."""
    edge = " " * (size // 2)
    joined = "".join(edge + text.lower() + edge for text in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    # Lower case may be longer than the text itself.
    lengths = [len(text.lower()) + 2 * len(edge) for text in texts]
    ends = np.cumsum(lengths)
    letter = letters()[points]
    keep = letter | np.roll(letter, 1)
    for k in range(len(edge)):
        keep[ends - 1 - k] = True
        keep[ends - np.asarray(lengths) + k] = True
    placed = np.concatenate([[0], np.cumsum(keep)])
    counted = np.concatenate([[0], np.cumsum(letter)])
    starts, stops = placed[ends - lengths], placed[ends]
    values = (points * letter)[keep].astype(U64)
    many = len(values) - size + 1
    if many <= 0:
        return np.zeros(0, U64), np.zeros(len(texts) + 1, np.int64), counted[ends] - counted[ends - lengths]
    code = values[:many].copy()
    for k in range(1, size):
        code = code * U64(0x100000001B3) + values[k : many + k]
    own = np.ones(many, bool)
    for k in range(size - 1):
        # Windows that would reach into the next text.
        own[np.minimum(stops[:-1] - 1 - k, many - 1)] = False
    before = np.concatenate([[0], np.cumsum(own)])
    begins = before[np.minimum(np.append(starts, stops[-1]), many)]
    return mixed(code[own]), begins, counted[ends] - counted[ends - lengths]


def _chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= CHUNK_CHARS or i + 1 == len(texts):
            yield first, texts[first : i + 1]
            first, size = i + 1, 0


def slots(hashes: np.ndarray, table_size: int) -> tuple[np.ndarray, np.ndarray]:
    last = U64(table_size - 1)
    return (hashes & last).astype(np.int64), ((hashes >> U64(32)) & last).astype(np.int64)


def bits(masks: np.ndarray, language: int) -> np.ndarray:
    """The bit of a language, by its number, in each mask."""
    word, place = divmod(language, 8 * masks.itemsize)
    return (masks[:, word] >> masks.dtype.type(place)) & masks.dtype.type(1)


def held_out(doc_id: str) -> Column:
    """Whether a document is kept from learning."""
    remainder = F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4))
    return F.coalesce(remainder == 2, F.lit(False))


def learn(df: DataFrame, text: str, language: str, doc_id: str, settings: Learning) -> Filters:
    """Filters from the rows of ``df``, which must not contain held-out ones."""
    rows = df.where(F.col(language).isNotNull() & F.col(doc_id).isNotNull()).select(
        F.col(language).alias("lang"), F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("text")
    )
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang")
    known = [(row["lang"], row["n"]) for row in counts.collect()]
    languages = [name for name, _ in known]
    if not languages:
        return Filters([], np.zeros((1, 1), np.uint8), np.zeros(0), settings.size)
    share = F.create_map(*[F.lit(x) for name, n in known for x in (name, settings.documents / n)])
    draw = F.pmod(F.xxhash64(F.lit(settings.seed), "id"), F.lit(1 << 20)) / F.lit(1 << 20)
    number = {name: k for k, name in enumerate(languages)}
    size = settings.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, np.ndarray]] = []
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, chunk in _chunks(texts):
                codes, begins, _ = grams(chunk, size)
                for k in range(len(chunk)):
                    found.append((number[names[first + k]], np.unique(codes[begins[k] : begins[k + 1]])))
                if sum(len(f) for _, f in found) > 4_000_000:
                    yield from counted(found)
                    found = []
        yield from counted(found)

    def counted(found):
        for k in sorted({k for k, _ in found}):
            codes, n = np.unique(np.concatenate([c for j, c in found if j == k]), return_counts=True)
            yield pa.record_batch(
                [pa.array(np.full(len(codes), k, np.int32)), pa.array(codes.view(np.int64)), pa.array(n)],
                names=["lang", "gram", "n"],
            )

    sample = rows.where(draw < share[F.col("lang")])
    least = [
        max(1.0 if n < settings.few else 2.0, settings.share * min(n, settings.documents)) for _, n in known
    ]
    enough = F.lit(least)
    usual = (
        sample.select("lang", "text")
        .mapInArrow(run, "lang INT, gram BIGINT, n BIGINT")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= enough[F.col("lang")])
        .select("lang", "gram")
        .toArrow()
    )
    lang, gram = usual["lang"].to_numpy(), usual["gram"].to_numpy().view(U64)
    most = int(np.bincount(lang, minlength=1).max()) if len(lang) else 1
    size_of_table = 1 << max(12, (settings.slots_per_gram * most - 1).bit_length())
    kind = np.uint8 if len(languages) <= 8 else U64
    table = np.zeros((size_of_table, -(-len(languages) // 64)), kind)
    order = np.argsort(lang, kind="stable")
    ends = np.searchsorted(lang[order], np.arange(len(languages) + 1))
    for k in range(len(languages)):
        word, place = divmod(k, 8 * table.itemsize)
        for slot in slots(gram[order[ends[k] : ends[k + 1]]], size_of_table):
            table[slot, word] |= table.dtype.type(1 << place)
    full = np.array([np.count_nonzero(bits(table, k)) for k in range(len(languages))])
    return Filters(languages, table, (full / size_of_table) ** 2, settings.size)


def decide(texts: list[str | None], filters: Filters) -> tuple[list[str], list[float]]:
    """Language and score of each text; the score is the share of its n-grams that the
    language explains."""
    names, scores = [], []
    for _, chunk in _chunks([text or "" for text in texts]):
        codes, begins, n_letters = grams(chunk, filters.size)
        one, two = slots(codes, len(filters.table))
        masks = filters.table[one] & filters.table[two]
        total = np.diff(begins)
        share = np.zeros((len(chunk), max(1, len(filters.languages))))
        for k, chance in enumerate(filters.by_chance):
            sums = np.concatenate([[0], np.cumsum(bits(masks, k), dtype=np.int64)])
            hits = np.diff(sums[begins])
            share[:, k] = (hits - total * chance) / np.maximum(total * (1 - chance), 1e-9)
        best = share.argmax(axis=1)
        for k in range(len(chunk)):
            if n_letters[k] and filters.languages:
                names.append(filters.languages[best[k]])
                scores.append(float(min(1.0, max(0.0, share[k, best[k]]))))
            else:
                names.append(UNKNOWN)
                scores.append(0.0)
    return names, scores


def predict(
    df: DataFrame,
    text: str = "text",
    language: str = "lang",
    doc_id: str = "doc_id",
    settings: Learning = Learning(),
) -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``held_out``, ``lang_pred``, ``score``.

    Learns from the rows that are not held out.
    """
    filters = learn(df.where(~held_out(doc_id)), text, language, doc_id, settings)
    sent = df.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = decide(batch.column(2).to_pylist(), sent.value)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = df.select(F.col(doc_id).cast("bigint"), held_out(doc_id), F.col(text))
    return rows.mapInArrow(run, "doc_id BIGINT, held_out BOOLEAN, lang_pred STRING, score DOUBLE")
