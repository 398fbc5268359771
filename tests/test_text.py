from datetime import date

import pytest
from pyspark.sql import functions as F

from lendspark.functions import text


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")
    rows = df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()
    return [row["out"] for row in rows]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("13.99%", 13.99),
        (" 13.99 % ", 13.99),
        ("\t5\n", 5.0),
        ("1e3", 1000.0),
        (".5", 0.5),
        ("-1", -1.0),
        ("", None),
        ("  ", None),
        ("%", None),
        ("abc", None),
        ("3d", None),
        ("3f", None),
        ("0x1p3", None),
        ("NaN", None),
        ("inf", None),
        ("-Infinity", None),
        ("1e999", None),
        ("1,000", None),
        (None, None),
    ],
)
def test_clean_numeric(spark, raw, expected):
    assert apply(spark, text.clean_numeric, [raw]) == [expected]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("3.0", 3),
        ("3.9", 3),
        ("2.9999999", 2),
        ("-5.9", -5),
        (" 7\t", 7),
        ("1e3", 1000),
        ("9007199254740993", 9007199254740993),
        ("99999999999999999999", None),
        ("inf", None),
        ("nan", None),
        ("3d", None),
        ("Total amount funded", None),
        ("", None),
        (None, None),
    ],
)
def test_to_int_cuts_off(spark, raw, expected):
    assert apply(spark, text.to_int, [raw]) == [expected]


def test_to_int_out_of_range_for_the_type(spark):
    assert apply(spark, lambda c: text.to_int(c, "int"), ["2147483647", "2147483648"]) == [
        2147483647,
        None,
    ]


def test_parse_term_reads_all_digits(spark):
    values = [" 36 months", "60", "36.5 months", "none", "", None]
    assert apply(spark, text.parse_term, values) == [36, 60, 365, None, None, None]


def test_parse_mon_year(spark):
    values = ["Dec-2015", " dec-2015 ", "DEC-2015", "Xyz-2015", "2003/08", "Dec-15", "", None]
    day = date(2015, 12, 1)
    assert apply(spark, text.parse_mon_year, values) == [day, day, day] + [None] * 5


def test_clean_text(spark):
    assert apply(spark, text.clean_text, [" a b\t", "", " \n ", None]) == ["a b", None, None, None]
