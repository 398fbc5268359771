"""Raw loan text to typed loans, with rejected rows accounted for."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.constants import DATE_COLUMNS, LOAN_COLUMNS, LOAN_SCHEMA
from lendspark.functions.dates import epoch_ms_to_date
from lendspark.functions.measures import row_count
from lendspark.functions.text import (
    clean_numeric,
    clean_text,
    parse_mon_year,
    parse_term,
    to_int,
)

BAD_ID = "id"
BAD_DATE = "date"


def _typed(field) -> Column:
    raw = F.col(field.name)
    if field.name == "term":
        return parse_term(raw)
    kind = field.dataType.simpleString()
    if kind in ("int", "bigint"):
        return to_int(raw, kind)
    if kind == "double":
        return clean_numeric(raw)
    if kind == "date":
        return parse_mon_year(raw)
    return clean_text(raw)


def tag_loans(raw: DataFrame) -> DataFrame:
    """All rows, typed, with ``reject_reason`` (NULL for a row to keep).

    A row is rejected for an id that is missing or no number, and otherwise for a
    date that is filled in but cannot be read. A blank date is merely unknown.
    """
    typed = raw.select(
        *[_typed(field).alias(field.name) for field in LOAN_SCHEMA],
        *[clean_text(F.col(name)).isNotNull().alias(f"_has_{name}") for name in DATE_COLUMNS],
    )
    unreadable = [F.col(f"_has_{name}") & F.col(name).isNull() for name in DATE_COLUMNS]
    reason = F.when(F.col("id").isNull(), BAD_ID).when(reduce(or_, unreadable), BAD_DATE)
    return typed.select(*LOAN_COLUMNS, reason.alias("reject_reason"))


def clean_loans(raw: DataFrame) -> DataFrame:
    """The typed rows that pass, in the canonical column order."""
    tagged = tag_loans(raw)
    # A filter on generated columns stays above them; others go below, where each column they
    # use is parsed out of its record again.
    rows = tagged.select(F.inline(F.array(F.struct(*tagged.columns))))
    return rows.where(F.col("reject_reason").isNull()).select(*LOAN_COLUMNS)


def clean_report(raw: DataFrame) -> DataFrame:
    """One row: how many rows are kept, and how many are dropped for which reason."""
    reason = F.col("reject_reason")
    return tag_loans(raw).agg(
        F.count_if(reason.isNull()).alias("rows_written"),
        F.count_if(reason == BAD_ID).alias("skipped_id"),
        F.count_if(reason == BAD_DATE).alias("skipped_dates"),
    )


def unreadable_values(raw: DataFrame) -> DataFrame:
    """Per column, fields that hold text of which nothing usable could be made.

    They become NULL in a row that is kept, so this is the place to notice them.
    """
    counts = raw.agg(
        *[
            F.count_if(clean_text(F.col(field.name)).isNotNull() & _typed(field).isNull()).alias(
                field.name
            )
            for field in LOAN_SCHEMA
        ]
    )
    return counts.unpivot([], LOAN_COLUMNS, "column_name", "unreadable")


def restore_dates(df: DataFrame, columns=tuple(DATE_COLUMNS)) -> DataFrame:
    """Turn epoch-millisecond columns into dates; real dates are left alone."""
    types = dict(df.dtypes)
    staged = [name for name in columns if types[name] not in ("date", "timestamp")]
    return df.withColumns({name: epoch_ms_to_date(F.col(name)) for name in staged})


def record_count(df: DataFrame) -> DataFrame:
    return df.agg(row_count().alias("total_rows"))


def sample_rows(df: DataFrame, key: str = "id", rows: int = 10) -> DataFrame:
    """The rows with the lowest keys."""
    return df.orderBy(key).limit(rows)
