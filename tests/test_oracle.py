"""Every query against its SQL on the given tables."""

import pytest

import __spark_entry__ as entry
from workload import queries as catalogue
from tests.compare import connect, differences
from tests.conftest import SF

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLE[name]) is None


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert {query.__name__ for query in catalogue.ALL} <= set(ORACLE)


def test_entry(spark):
    assert entry.entry(spark).columns == ["UserId", "ProductId", "Score", "user_index", "item_index"]
