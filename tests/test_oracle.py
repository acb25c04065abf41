"""Every registered query against its DuckDB oracle on the small tables.

The driver repeats this comparison at sf0.01; here sf0.001 keeps the suite
quick.  Set PLAYLENS_ORACLE_SF to another directory to run it elsewhere.
"""

import os

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_compare import compare, duckdb_connection
from playlens.oracle import SQL
from playlens.queries import QUERIES

SF = os.environ.get("PLAYLENS_ORACLE_SF", SF_SMALL)


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["kind", "title", "views", "rank"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, SF, QUERIES[name], SQL.get(name))
    assert res["status"] == "match", res
