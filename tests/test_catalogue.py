"""Every registered query against its DuckDB oracle, at sf0.001 (the driver checks sf0.01)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from driftgate.plans import registry
from conftest import SF_SMALL
from oracle_compare import compare, duck

NAMES = list(registry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(registry.oracle_sql()) == set(registry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg, _ = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].overall_verdict == "FAIL"
