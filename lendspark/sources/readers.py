"""Sources. Types are always declared, never inferred from the data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendspark.constants import LOAN_COLUMNS
from lendspark.session import compile_wide_rows
from lendspark.sources import split_csv


# Where Spark puts a record that does not have the fields of the header.
BROKEN = "_broken_record"


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``df`` with blanks around its column names removed.

    Raises ``ValueError`` naming, in order, the columns that are not there.
    """
    df = df.toDF(*[name.strip() for name in df.columns])
    absent = [name for name in sorted(set(columns)) if name not in df.columns]
    if absent:
        raise ValueError(f"The header lacks: {', '.join(absent)}")
    return df


def _asks_for(columns: Iterable[str]) -> Column:
    """True for every row, but not to be known without all of ``columns``.

    Fields that nobody asks for are not parsed, and so not checked.
    """
    return F.xxhash64(*[F.col(f"`{name}`") for name in columns]) >= F.lit(-(2**63))


def read_raw_csv(
    spark: SparkSession,
    path: str,
    columns: Iterable[str] = tuple(LOAN_COLUMNS),
    multi_line: bool = True,
) -> DataFrame:
    """The wanted text columns of a headered CSV export, in the given order.

    An empty field is NULL; undecodable bytes become the replacement character. Quoted
    fields may hold line breaks, and files are split between tasks all the same, see
    :mod:`lendspark.sources.split_csv`. With ``multi_line`` off no pass looks for such
    breaks, and a record that is not complete on its line fails the read.
    """
    columns = list(columns)
    compile_wide_rows(spark)
    options = {"header": True, **split_csv.OPTIONS}
    if multi_line:
        records = split_csv.whole_records(spark, path)
        if records is None:
            raw = spark.read.csv(path, **options)
        else:
            names = spark.read.csv(path, multiLine=True, **options).columns
            fields = split_csv.parsed(records, ["STRING"] * len(names))
            raw = records.where("NOT head").select(fields.alias("r")).select("r.*").toDF(*names)
        return require_columns(raw, columns).select(*columns)
    names = spark.read.csv(path, **options).columns
    fields = [T.StructField(name, T.StringType()) for name in [*names, BROKEN]]
    lines = spark.read.csv(
        path, schema=T.StructType(fields), columnNameOfCorruptRecord=BROKEN, **options
    )
    message = F.concat(F.lit("Not a whole record on this line: "), F.col(BROKEN))
    broken = _asks_for(names) & F.col(BROKEN).isNotNull()
    whole = lines.where(F.when(broken, F.raise_error(message).cast("boolean")).otherwise(True))
    return require_columns(whole.drop(BROKEN), columns).select(*columns)


def load_typed_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A cleaned CSV under a declared schema.

    A header that differs from the schema, or a value of the wrong type in any column,
    whether it is selected afterwards or not, fails the load.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    options = {"nullValue": "", "mode": "FAILFAST"}
    records = split_csv.whole_records(spark, path)
    if records is None:
        loaded = spark.read.csv(
            path, schema=schema, header=True, enforceSchema=False, **split_csv.OPTIONS, **options
        )
    else:
        loaded = _typed_records(records, schema, options)
    return loaded.where(_asks_for(loaded.columns))


def _typed_records(records: DataFrame, schema: T.StructType, options: dict) -> DataFrame:
    """The fields of records under ``schema``; a header of other names fails the read."""
    names, count = schema.fieldNames(), len(schema)
    # A field more than the schema has, so that a longer header is seen.
    header = split_csv.parsed(records, ["STRING"] * (count + 1), nullValue="")
    agree = F.array(*[F.lower(F.btrim(header[f"c{k}"])) for k in range(count)]) == F.array(
        *[F.lit(name.lower()) for name in names]
    )
    agree = F.coalesce(agree, F.lit(False)) & header[f"c{count}"].isNull()
    message = F.concat(F.lit("The header is not that of the schema: "), F.col("record"))
    wrong = F.raise_error(message).cast("boolean")
    rows = records.where(F.when(~F.col("head"), F.lit(True)).when(agree, F.lit(False)).otherwise(wrong))
    fields = split_csv.parsed(rows, [f.dataType.simpleString() for f in schema], **options)
    return rows.select(fields.alias("r")).select("r.*").toDF(*names)


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_source(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A table by that name, or else the Parquet dataset at that path."""
    try:
        return spark.table(name_or_path)
    except (AnalysisException, ParseException):
        return spark.read.parquet(name_or_path)
