"""The queries that SQL can express, against DuckDB."""

from __future__ import annotations

import pytest

from check_oracle import compare, open_duckdb
from sheaf.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"


#: Queries whose limits the smallest tables don't reach.
LARGER = {"op6_line_frequency": "/root/testdata/sf0.01", "op12_collocations": "/root/testdata/sf0.01"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    sf = LARGER.get(name, SF)
    ok, line = compare(spark, open_duckdb(sf), sf, name)
    assert ok, line
