"""Every registered query against its SQL, on the smallest files."""

import pytest
from conftest import SMALL

from checks.compare import connect, differences
from checks.oracle import statements
from rosterloom.registry import all_queries

QUERIES, SQL = all_queries(), statements()


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SMALL), connection, SQL[name]) is None
