import os

import duckdb
import pytest

import __spark_entry__ as entry
from adcube.queries import QUERIES
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert "unique_key" in df.columns and df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(entry.oracle_sql()[name])
    o_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(o_rows)
    assert digest(df.columns, rows)[0] == digest(rel.columns, o_rows)[0]


@pytest.mark.parametrize("name", ["report_by_ad", "report_by_keyword", "report_by_campaign_eur", "staging_ad"])
def test_shuffle_join_fallbacks_match_oracle(spark, con, name):
    """Same results when nothing may be broadcast (sort-merge joins, NULL keys spread out)."""
    from adcube import queries as Q
    from adcube.plans.reports import report
    from adcube.plans.staging import staging_ad
    cfg = Q.EUR if name.endswith("_eur") else Q.USD
    build = {
        "report_by_ad": lambda: report("ad", Q._src(spark, SF), cfg),
        "report_by_keyword": lambda: report("keyword", Q._src(spark, SF), cfg),
        "report_by_campaign_eur": lambda: report("campaign", Q._src(spark, SF), cfg),
        "staging_ad": lambda: staging_ad(Q._src(spark, SF), cfg),
    }[name]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = Q.rounded(build())
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rel = con.sql(entry.oracle_sql()[name])
    assert digest(df.columns, rows)[0] == digest(rel.columns, rel.fetchall())[0]
