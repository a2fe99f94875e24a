"""Every registered query gives the rows of its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
from cinderlog.plans.oracles import ORACLES
from cinderlog.plans.queries import REGISTERED
from tests.compare import connect, difference


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(name, spark, sf_dir, con):
    assert difference(registry.queries()[name](spark, sf_dir), con, registry.oracle_sql()[name]) is None


def test_every_query_of_the_reference_has_sql():
    assert {query.__name__ for query in REGISTERED} == set(ORACLES)
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry_counts_levels(spark):
    rows = registry.entry(spark).collect()
    assert {r["level"] for r in rows} == {"TRACE", "DEBUG", "INFO", "WARN", "ERROR"}
    assert sum(r["n"] for r in rows) == 1000
