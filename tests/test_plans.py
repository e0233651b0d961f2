import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from adcube.config import EngineConfig
from adcube.operators.goals import discover_goals
from adcube.operators.rollup import measure_columns, report_window_start
from adcube.plans.reports import rates_for, report_table_name
from adcube.plans.staging import staging_campaign
from adcube.session import tune_for_scale
from adcube.sources import testdata

SF = "/root/testdata/sf0.001"
D = dt.date


def test_unknown_conversion_measure_rejected():
    with pytest.raises(ValueError):
        EngineConfig(conversion_measure="clicks")


def test_non_numeric_measure_rejected(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 1, "x", 2)], "date date, ad_id long, device string, clicks long")
    with pytest.raises(TypeError):
        measure_columns(df, df.columns, ["date"], ["ad_id"])
    assert measure_columns(df, df.columns, ["date", "device"], ["ad_id"]) == ["clicks"]


def test_goals_have_no_cap_unless_asked_for(spark):
    conv = spark.createDataFrame([(f"g{i}",) for i in range(700)], "goal string")
    assert len(discover_goals(conv)) == 700
    conv = conv.limit(5)
    assert len(discover_goals(conv, max_goals=5)) == 5
    with pytest.raises(ValueError):
        discover_goals(conv, max_goals=4)


def test_duplicate_rate_dates_rejected_when_not_strict(spark):
    src = testdata.ad_sources(spark, SF)
    dup = src.currency.unionByName(src.currency.limit(1))
    bad = src.with_(currency=dup)
    cfg = EngineConfig(currency="EUR", as_of=D(2001, 6, 30))
    assert rates_for(bad, cfg.with_(strict=True)) is not None  # strict: reference keeps the fan-out
    with pytest.raises(Exception, match="duplicate dates"):
        rates_for(bad, cfg).collect()


def test_staging_without_conversions_has_no_goal_columns(spark):
    src = testdata.ad_sources(spark, SF, conversions=False)
    cols = staging_campaign(src, EngineConfig()).columns
    assert not [c for c in cols if c.endswith("_value")] and "last_updated" in cols


def test_explicit_goal_list_skips_discovery(spark):
    src = testdata.ad_sources(spark, SF)
    cols = staging_campaign(src, EngineConfig(goals=("2-HIGH",))).columns
    assert "2high" in cols and "1urgent" not in cols


def test_extra_exclude_drops_a_text_column(spark):
    from adcube.plans.reports import report
    src = testdata.ad_sources(spark, SF)
    src = src.with_(ad_report=src.ad_report.withColumn("ad_label", F.lit("Search")))
    with pytest.raises(TypeError, match="ad_label"):
        report("ad", src, EngineConfig())
    assert "ad_label" not in report("ad", src, EngineConfig(extra_exclude=("ad_label",))).columns


def test_unreadable_conversion_report_is_an_error(spark, tmpdir_path):
    from adcube.sources.catalog import SOURCE_TABLES, AdSources
    folder = f"{tmpdir_path}/{SOURCE_TABLES['ad_conversions']}"
    os.makedirs(folder)
    with open(f"{folder}/part-0.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        AdSources.from_parquet(spark, tmpdir_path)


def test_null_join_keys_are_spread_and_kept(spark):
    from adcube.operators.enrich import enrich
    fact = spark.createDataFrame([(1, 10), (None, 20), (2, 30)], "ad_id long, clicks long")
    dims = spark.createDataFrame([(1, "a"), (3, "c"), (None, "n")], "ad_id long, ad_text string")
    found = sorted(map(tuple, enrich(fact, dims, "ad_id").select("ad_id", "clicks", "ad_text").collect()), key=str)
    assert found == sorted([(1, 10, "a"), (None, 20, None), (2, 30, None)], key=str)


def test_window_and_names():
    assert report_window_start(D(2025, 1, 15), 31) == D(2024, 1, 1)
    assert report_window_start(D(2025, 2, 15), 31) == D(2025, 1, 1)
    assert report_table_name("ad", EngineConfig(namespace="prod")) == "prod_performance_by_ad"


def test_tune_for_scale(spark):
    conf = tune_for_scale(spark, 100 << 40)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409_600  # 256 MB each, no ceiling
    assert tune_for_scale(spark, 10 << 30)["spark.sql.shuffle.partitions"] == "40"
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_from_parquet_missing_conversion_report(spark, tmpdir_path):
    from adcube.sources.catalog import SOURCE_TABLES, AdSources
    src = testdata.ad_sources(spark, SF)
    for name in ("campaign_report", "campaigns", "accounts"):
        getattr(src, name).write.parquet(f"{tmpdir_path}/{SOURCE_TABLES[name]}")
    loaded = AdSources.from_parquet(spark, tmpdir_path)
    assert loaded.campaign_conversions is None and loaded.ads is None
    cols = staging_campaign(loaded, EngineConfig()).columns
    assert not [c for c in cols if c.endswith("_value")]
