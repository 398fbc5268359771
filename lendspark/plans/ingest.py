"""From a raw export to the curated table, with every row accounted for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.constants import LOAN_COLUMNS
from lendspark.functions.measures import row_count
from lendspark.operators import cleaning, validation
from lendspark.session import work_folder
from lendspark.sources import writers

KEPT = "kept"


def ingest(
    raw: DataFrame, table: str, rejects: str, path: str | None = None, buckets: int = 8
) -> DataFrame:
    """Clean, check and store raw loans; returns ``(reason, rows)``, one row per outcome.

    Good rows replace the curated ``table`` (at ``path``, if given); all others go to
    Parquet at ``rejects`` with the ``reason``: what made them unreadable, or else the
    rules they break. The raw text is read and parsed once. Keys must be unique among the
    good rows, or nothing is written.
    """
    spark = raw.sparkSession
    with work_folder(spark, "ingest") as folder:
        tagged = validation.tag_violations(cleaning.tag_loans(raw))
        reason = F.coalesce("reject_reason", "violated").alias("reason")
        writers.write_parquet(tagged.select(*LOAN_COLUMNS, reason), folder)
        rows = spark.read.parquet(folder)
        good = rows.where("reason IS NULL").select(*LOAN_COLUMNS)
        surplus = validation.check_key(good).first()["surplus_rows"]
        if surplus:
            raise validation.ConstraintViolation({"id_unique": surplus})
        writers.write_curated(good, table, buckets=buckets, path=path)
        writers.write_parquet(rows.where("reason IS NOT NULL"), rejects)
        outcomes = rows.groupBy(F.coalesce("reason", F.lit(KEPT)).alias("reason")).agg(
            row_count().alias("rows")
        )
        # As many rows as there are combinations of broken rules at most.
        return spark.createDataFrame(outcomes.collect(), outcomes.schema)
