"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import differences, duck
from trailmart.plans.catalog import QUERIES as CATALOG

# Queries over texts have their own tests.
QUERIES = {name: query for name, query in contract.queries().items() if name in CATALOG}
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in CATALOG}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_entry_returns_days(spark):
    result = contract.entry(spark)
    assert result.columns[0] == "event_date"
    assert result.count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) == set(CATALOG)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, connection, name):
    assert differences(QUERIES[name](spark, sf_dir), connection, SQL[name]) == []
