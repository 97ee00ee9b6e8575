"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from stintlab.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, data, name):
    assert difference(spark, con, data, name) is None


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert not entry.entry(spark).isEmpty()
