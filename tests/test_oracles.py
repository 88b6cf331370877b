"""Every registered query against its SQL counterpart, over whole tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import duck, mismatch

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, con, key):
    assert mismatch(QUERIES[key](spark, sf_dir), con, ORACLES[key]) is None


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_returns_rows(spark, sf_dir, key):
    assert QUERIES[key](spark, sf_dir).count() > 0


def test_every_statement_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0
