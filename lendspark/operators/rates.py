"""Outcome rates of settled loans by any grouping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.constants import BAD_STATUSES, PAID_STATUSES, SETTLED_STATUSES
from lendspark.functions.measures import percent, row_count


def outcome_rates(
    df: DataFrame,
    by: Sequence[Column],
    measures: Sequence[Column] = (),
    status: str = "loan_status",
) -> DataFrame:
    """Settled loans per group: how many, how they ended, and further measures.

    Select what is needed from the result; unused counts are pruned from the plan.
    """
    outcome = F.col(status)
    bad = F.count_if(outcome.isin(BAD_STATUSES))
    return (
        df.where(outcome.isin(SETTLED_STATUSES))
        .groupBy(*by)
        .agg(
            row_count().alias("total_loans"),
            bad.alias("defaulted"),
            F.count_if(outcome.isin(PAID_STATUSES)).alias("fully_paid"),
            percent(bad, row_count(), 2).alias("default_rate"),
            *measures,
        )
    )
