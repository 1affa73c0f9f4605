"""Every registered query with SQL equals it on the smallest tables."""

import compare
import pytest

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def con(sf):
    return compare.connect(sf)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, sf, name):
    problem = compare.differences(spark, con, name, sf)
    assert problem == "", problem


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
