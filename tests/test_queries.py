"""Every registered query against its SQL on the given tables, and the shape of the registry."""

import pytest

import __spark_entry__ as entry_points
from tests.compare import connect, differences

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, con, name):
    assert differences(spark, con, name, QUERIES[name], ORACLES[name], small) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["domain", "label", "n_pages", "n_chars"]
    assert set(ORACLES) <= set(QUERIES)
