"""Small expressions shared by reports and summaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_count() -> Column:
    return F.count(F.lit(1))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``part`` in percent of ``whole``, NULL for an empty whole."""
    return F.round(F.try_divide(part, whole) * 100, digits)


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0.0 for an empty whole."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def millionths(key: Column, seed: int) -> Column:
    """Repeatable pseudo-random integer in [0, 1 000 000) for a whole-number key.

    Plain arithmetic, so that the same rows are picked on every run, after a lost
    executor, and by any other SQL engine.
    """
    spread = F.pmod(key, F.lit(1_000_003)) * F.lit(2_654_435_761)
    return (spread + F.lit(seed)) % F.lit(1_000_000)
