"""Every registered query beside its DuckDB text, over the whole tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle_check import compare, connect

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_matches_oracle(name, spark, sf_dir, con):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_rows_only(name, spark, tiny_dir):
    assert QUERIES[name](spark, tiny_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0
