"""Integrity rules, checked in one pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.constants import LOAN_RULES
from lendspark.functions.measures import row_count


class ConstraintViolation(ValueError):
    """Raised by :func:`enforce`; ``counts`` holds violations per broken rule."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        detail = ", ".join(f"{rule}: {n}" for rule, n in counts.items())
        super().__init__(f"Constraint violations: {detail}")


def _broken(rule: str):
    # An unknown result is not a violation.
    return F.coalesce(~F.expr(rule), F.lit(False))


def check_key(df: DataFrame, key: str = "id") -> DataFrame:
    """One row: rows without a key, keys used twice or more, and their surplus rows."""
    per_key = df.groupBy(key).agg(row_count().alias("n"))
    known = F.col(key).isNotNull()
    repeated = known & (F.col("n") > 1)
    return per_key.agg(
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count_if(repeated).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("n") - 1)), F.lit(0)).alias("surplus_rows"),
    )


def check_rules(df: DataFrame, rules: Mapping[str, str] = LOAN_RULES) -> DataFrame:
    """Violations per rule, one row each, from a single aggregate."""
    counts = df.agg(*[F.count_if(_broken(rule)).alias(name) for name, rule in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations")


def tag_violations(df: DataFrame, rules: Mapping[str, str] = LOAN_RULES) -> DataFrame:
    """``df`` with ``violated``: the broken rules, comma-separated, NULL if none."""
    names = [F.when(_broken(rule), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("violated", F.nullif(F.concat_ws(",", *names), F.lit("")))


def quarantine(
    df: DataFrame, rules: Mapping[str, str] = LOAN_RULES
) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and the others with the rules they break."""
    tagged = tag_violations(df, rules)
    good = tagged.where(F.col("violated").isNull()).drop("violated")
    return good, tagged.where(F.col("violated").isNotNull())


def enforce(
    df: DataFrame, rules: Mapping[str, str] = LOAN_RULES, key: str | None = "id"
) -> DataFrame:
    """``df`` unchanged, or :class:`ConstraintViolation` if any row breaks a rule."""
    counts = {row["rule"]: row["violations"] for row in check_rules(df, rules).collect()}
    if key is not None:
        keys = check_key(df, key).first()
        counts[f"{key}_not_null"] = keys["null_keys"]
        counts[f"{key}_unique"] = keys["surplus_rows"]
    broken = {rule: n for rule, n in counts.items() if n}
    if broken:
        raise ConstraintViolation(broken)
    return df
