"""Every registered query against its DuckDB text, value for value."""

import __spark_entry__ as entry
import pytest
from attrition.plans import registered
from compare import connect, difference

ORACLES = entry.oracle_sql()
QUERIES = {name: query for name, query in entry.queries().items() if name in registered.QUERIES}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(registered.QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 3
