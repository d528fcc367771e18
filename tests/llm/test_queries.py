"""Registered text queries: SQL where there is some, contracts where there is none."""

from __future__ import annotations

from collections import Counter

import pytest

from compare import differences, duck
from trailmart.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, connection, name):
    assert differences(QUERIES[name](spark, sf_dir), connection, SQL[name]) == []


def test_every_operator_is_registered():
    assert Counter(name.split("_")[0] for name in QUERIES) == Counter(f"op{n}" for n in range(1, 14))


def test_entry_registers_them():
    import __spark_entry__ as contract

    assert {*QUERIES, "pipeline"} <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())
