"""Every registered query against its SQL, on the smallest data."""

import pytest

import __spark_entry__ as entry
from oracle import connect, differences
from tablework import catalog


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["sales_date", "orders", "net_revenue"]


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_its_sql(spark, con, sf_dir, name):
    assert differences(catalog.queries()[name](spark, sf_dir), con, catalog.oracle_sql()[name]) == []
