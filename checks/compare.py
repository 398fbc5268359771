"""Run registered queries against their SQL and report differences."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

# Integers of any width compare as equal kinds, as do the two spellings of text.
KINDS = {
    "tinyint": "integer",
    "smallint": "integer",
    "int": "integer",
    "bigint": "integer",
    "string": "text",
    "double": "double",
    "boolean": "boolean",
    "TINYINT": "integer",
    "SMALLINT": "integer",
    "INTEGER": "integer",
    "BIGINT": "integer",
    "VARCHAR": "text",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value


def differences(df: DataFrame, connection, sql: str) -> list[str]:
    """What sets the two results apart; empty if nothing does."""
    expected = connection.sql(sql)
    names = sorted(df.columns)
    if names != sorted(expected.columns):
        return [f"columns {names} vs {sorted(expected.columns)}"]
    ours = {name: KINDS.get(kind, kind) for name, kind in df.dtypes}
    theirs = {n: KINDS.get(str(t), str(t)) for n, t in zip(expected.columns, expected.types)}
    found = [f"type of {n}: {ours[n]} vs {theirs[n]}" for n in names if ours[n] != theirs[n]]

    rows = Counter(tuple(map(_cell, row)) for row in df.select(*names).collect())
    quoted = ", ".join(f'"{name}"' for name in names)
    wanted = Counter(tuple(map(_cell, row)) for row in expected.project(quoted).fetchall())
    if rows != wanted:
        found.append(
            f"{sum(rows.values())} vs {sum(wanted.values())} rows;"
            f" only ours {list((rows - wanted).items())[:3]};"
            f" only expected {list((wanted - rows).items())[:3]}"
        )
    return found
