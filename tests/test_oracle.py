"""Every registered query against its DuckDB oracle (the driver's gate),
here on sf0.001 for speed; ``tests/run_oracle.py`` runs the sf0.01 check."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from oracle_harness import compare, duck

from conftest import SF_SMALL
from flowlab.plans.registry import ALL_QUERIES

QUERIES = contract.queries()
ORACLES = contract.oracle_sql()
# the optional text queries that SQL cannot express have brute-force tests of their own


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(ALL_QUERIES) <= set(ORACLES) <= set(QUERIES)


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert df.columns == ["event_type", "n"] and df.count() >= 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    assert ok, msg
