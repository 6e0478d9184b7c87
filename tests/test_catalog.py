"""Every catalogued query against its DuckDB oracle on the small warehouse,
and the driver entry points."""

import pytest

import __spark_entry__ as entry_mod
from oracle.compare import compare, duck
from oracle.duckdb_sql import SQL
from transitlake.catalog import QUERIES


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_small, name):
    ok, msg = compare(QUERIES[name](spark, sf_small), con, SQL[name])
    assert ok, msg


def test_entry_points(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    # every catalogued query has its SQL; of the optional operators some are beyond SQL
    assert set(QUERIES) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
