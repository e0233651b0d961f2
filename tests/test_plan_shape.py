"""Regression guards on physical plans of the registered queries."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["report_by_ad", "report_by_keyword", "report_by_campaign_eur", "staging_ad",
                                  "upsert_entity_keys", "declared_tests"])
def test_no_cross_or_nested_loop_joins(spark, name):
    p = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_report_rolls_up_in_one_pass(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(entry.queries()["report_by_campaign"](spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("Generate") == 1 and "Union" not in p
    assert "WindowGroupLimit" in p  # latest-version dimensions limit before the shuffle


def test_incremental_cut_is_pushed_to_the_scan(spark):
    from adcube.config import EngineConfig
    from adcube.plans.staging import staging_campaign
    from adcube.sources import testdata
    import datetime as dt
    df = staging_campaign(testdata.ad_sources(spark, SF), EngineConfig(goals=()), since=dt.date(2000, 1, 1))
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" in p and "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in p


def test_rollup_shuffles_only_partial_aggregates(spark):
    """A hot entity is combined in every map task before the single shuffle."""
    from pyspark.sql import functions as F

    from adcube.operators.rollup import period_rollup
    hot = spark.range(1000).select(F.lit(1).cast("long").alias("campaign_id"),  # one key holds every row
                                   F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int"))
                                   .alias("date"), F.col("id").alias("clicks"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = period_rollup(hot, ["campaign_id"], ["clicks"])
        p = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("Exchange") == 1 and "partial_sum" in p
    assert out.where("date_granularity = 'year'").first()["clicks"] == sum(range(1000))


def _jobs(spark, build):
    """Jobs that building a DataFrame starts."""
    tracker = spark.sparkContext.statusTracker()
    group = f"build-{id(build)}"
    spark.sparkContext.setJobGroup(group, "build")
    try:
        df = build()
        return df, len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_building_a_report_runs_no_pass_over_the_facts_but_goals(spark):
    from adcube.config import EngineConfig
    from adcube.plans.reports import report
    from adcube.sources import testdata
    src = testdata.ad_sources(spark, SF)
    _, jobs = _jobs(spark, lambda: report("ad", src, EngineConfig(goals=("2-HIGH",))))
    assert jobs == 0


def test_raw_report_is_scanned_once_after_the_account_maxima(spark):
    from adcube.config import EngineConfig
    from adcube.plans.staging import staging_campaign
    from adcube.sources import testdata
    df = staging_campaign(testdata.ad_sources(spark, SF), EngineConfig(goals=()))
    assert plan(df).count("l_quantity") and plan(df).count("lineitem.parquet") == 1


def test_aggregated_facts_join_their_goals_without_another_exchange(spark):
    from adcube.config import EngineConfig
    from adcube.plans.staging import staging_keyword
    from adcube.sources import testdata
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        src = testdata.ad_sources(spark, SF)
        src = src.with_(keyword_report=spark.createDataFrame(src.keyword_report.limit(50).toPandas()),
                        keyword_conversions=spark.createDataFrame(src.keyword_conversions.limit(50).toPandas()))
        p = plan(staging_keyword(src, EngineConfig(goals=("2-HIGH",)), sync_time=False))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # facts: partial sums, then the join keys; goals: one
    assert p.count("Exchange hashpartitioning") == 3
