"""The registered queries with SQL against DuckDB on the smallest test tables."""

from collections import Counter

import duckdb
import pytest
from data import SF

from adcube.llm import oracle, queries


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_sql(llm, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = queries.QUERIES[name](llm, SF)
    expected = con.sql(oracle.oracle_sql()[name])
    assert found.columns == expected.columns
    assert Counter(tuple(r) for r in found.collect()) == Counter(expected.fetchall())
