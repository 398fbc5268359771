"""Raw text fields to typed values. Bad input gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\r\x0b\x0c"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def clean_text(text: Column) -> Column:
    """Trimmed text, NULL if nothing is left."""
    return F.nullif(strip(text), F.lit(""))


# Java would also take '3d', '3f' and hexadecimal floats, and Spark 'Infinity' and
# 'NaN'; none of those is an amount.
PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def clean_numeric(text: Column) -> Column:
    """``' 13.99%'`` to 13.99. What is too large for a double is no amount either."""
    bare = F.replace(text, F.lit("%"), F.lit(""))
    number = F.when(bare.rlike(PLAIN_NUMBER), bare).try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def to_int(text: Column, type_name: str = "bigint") -> Column:
    """``'3.0'`` to 3, cutting the fraction off; out of range gives NULL."""
    return text.try_cast("decimal(38,18)").try_cast(type_name)


def parse_term(text: Column) -> Column:
    """``' 36 months'`` to 36: whatever digits there are, read as one number."""
    return F.regexp_replace(text, r"\D", "").try_cast("int")


def parse_mon_year(text: Column) -> Column:
    """``'Dec-2015'`` to the first of that month."""
    return F.try_to_date(strip(text), "MMM-yyyy")
