"""Every registered query equals its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from metroscope.catalogue import ORACLES, QUERIES

from .oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_sql(spark, con, key):
    assert compare(QUERIES[key](spark, FOLDER), con, ORACLES[key]) is None


def test_contract(spark):
    import __spark_entry__ as contract

    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    scored = contract.entry(spark)
    assert scored.columns == ["venue_id", "jour", "validations", "dow_median", "excess", "ratio", "pctile"]
    assert scored.count() > 0
