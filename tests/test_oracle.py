"""Every SQL-checked query equals its DuckDB oracle on sf0.001."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from data_paths import SF0001
from oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_duckdb(spark, con, name):
    ok, msg = compare(spark, name, SF0001, con)
    assert ok, msg


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 1 and rows[0].auc == 0.572797
