"""Labelled numeric buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendspark.constants import Buckets


def bucket(value: Column, buckets: Buckets) -> Column:
    """Label of the bucket that holds ``value``."""
    cases = []
    if buckets.null_label is not None:
        cases.append((value.isNull(), buckets.null_label))
    cases += [(value < upper, label) for upper, label in buckets.below]
    if buckets.up_to is not None:
        upper, label = buckets.up_to
        cases.append((value <= upper, label))

    chain = F
    for condition, label in cases:
        chain = chain.when(condition, label)
    return chain.otherwise(buckets.rest)
