"""An incremental report looks up the entities of its batch only."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adcube.config import EngineConfig
from adcube.plans.dims import hierarchy
from adcube.plans.reports import report
from adcube.sources import testdata

SF = "/root/testdata/sf0.001"
CFG = EngineConfig(goals=("2-HIGH",))


@pytest.fixture
def src(spark, tmpdir_path):
    """The sources with histories read from files, so that scans and their filters show in plans."""
    s = testdata.ad_sources(spark, SF)
    for name in ("ads", "ad_groups", "campaigns", "accounts", "keywords"):
        getattr(s, name).write.parquet(f"{tmpdir_path}/{name}")
        s = s.with_(**{name: spark.read.parquet(f"{tmpdir_path}/{name}")})
    return s


@pytest.mark.parametrize("entity", ["campaign", "ad", "keyword"])
@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_rows_are_those_of_the_whole_hierarchy(spark, src, entity, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        start = dt.date(2000, 1, 1)
        found = report(entity, src, CFG, window_start=start)
        whole = report(entity, src, CFG, window_start=start).drop("campaign_type_default")
        key = f"{entity}_id"
        plain = hierarchy(src, entity, CFG)
        named = [c for c in plain.columns if c != key]
        expected = whole.drop(*named, "unique_key").join(plain, key, "left")
        same = lambda df: sorted((tuple(map(str, r)) for r in df.select(key, "date", "date_granularity", *named).collect()))
        assert same(found) == same(expected)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_versions_of_touched_ids_are_shuffled(spark, src):
    ids = src.ads.where("id % 50 = 1").select("id").distinct()
    n = src.ads.join(ids, "id", "left_semi").count()
    versions = []
    from adcube.plans import dims

    inner = dims.latest_versions
    try:
        dims.latest_versions = lambda history, *a: versions.append((history.count(), history)) or inner(history, *a)
        hierarchy(src, "ad", CFG, ids.toDF("ad_id")).collect()
    finally:
        dims.latest_versions = inner
    # What the window's exchange gets, level by level.
    assert versions[0][0] == n < src.ads.count() / 10
    assert versions[1][0] <= src.ad_groups.count() and len(versions) == 4
    p = versions[0][1]._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in p and "Window" not in p


def test_large_id_sets_filter_the_scan_by_a_bloom_filter(spark, src):
    """Neither side is small: the ids reach the scan of the history before its exchange."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
            "spark.sql.adaptive.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        wanted = src.ads.where("status = 'Archived'").select("id")
        from adcube.plans.dims import _report_dim
        from adcube.session import written
        p = _report_dim(src, "ads", written(wanted.distinct().where(F.col("id") > 0)).where("id > 5"))._jdf.queryExecution().executedPlan().toString()
        assert "might_contain" in p and p.index("Window") < p.index("might_contain")
    finally:
        for k in conf:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
