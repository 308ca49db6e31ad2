"""Every registered query against its DuckDB twin on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from check_oracle import compare, open_duckdb

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return open_duckdb(SF)


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, line = compare(spark, con, SF, name)
    assert ok, line


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["collection", "date", "n_summaries", "summaries", "n_rejected"]
    assert df.count() > 0
