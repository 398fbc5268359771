"""Date expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLIS_PER_DAY = 86_400_000


def epoch_ms_to_date(millis: Column) -> Column:
    """UTC calendar day of an epoch-millisecond value, whatever the session zone."""
    days = F.floor(millis.cast("bigint") / F.lit(MILLIS_PER_DAY))
    return F.date_from_unix_date(days.cast("int"))


def month_angle(day: Column) -> Column:
    return F.lit(2.0 * math.pi) * F.month(day) / F.lit(12.0)
