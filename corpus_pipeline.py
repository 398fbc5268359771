"""From raw documents to packed token sequences, one operator after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.llm import chosen_path, grace, line_quality, packing
from lendspark.llm.common import stored
from lendspark.llm.mixing import Mix, mix_sources
from lendspark.llm.queries import LANGUAGE_WEIGHTS, source_levels, table, tokenizer_path

# As many tokens as are left; languages that lack some repeat documents in seeded epochs.
MIX = Mix(weights=LANGUAGE_WEIGHTS)

# A line of so many documents of a host is removed, however large the host is.
LIMITS = line_quality.Limits(most_documents=1000)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left of the documents that pass the rules."""
    return line_quality.keep_good(docs, limits=LIMITS)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return grace.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chosen_path.keep_first(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs, source_levels(), MIX).select("row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = packing.pack(docs, packing.Packing(tokenizer_path()))
    return packed.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("best_fit_packing", best_fit_packing),
]

# Token ids cannot be had in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
