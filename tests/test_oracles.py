"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from checks.compare import connect, differences
from tests.conftest import SMALL

QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_result_as_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SMALL), duck, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() == 7
