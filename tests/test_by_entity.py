"""Reports of many entities are built where each entity's rows lie; merges join only what a batch may replace."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adcube.config import EngineConfig
from adcube.plans import checks
from adcube.plans.reports import report
from adcube.plans.staging import staging_ad, staging_keyword
from adcube.sinks.table import merge_by_key, read_table, upsert_by_key, write_table
from adcube.sources import testdata

SF = "/root/testdata/sf0.001"
CFG = EngineConfig(goals=("1-URGENT", "2-HIGH", "3-MEDIUM"))


@pytest.fixture
def plain_plans(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(k, v)
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    for k, v in kept.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("entity, staging", [("ad", False), ("keyword", False), ("ad", True)])
def test_rolled_up_rows_are_not_shuffled(spark, plain_plans, entity, staging):
    src = testdata.ad_sources(spark, SF)
    key = f"{entity}_id"
    df = report(entity, src, CFG, staging=staging_ad(src, CFG, sync_time=False) if staging else None)
    p = plain_plans(df.where(F.col(key).isNotNull()))
    assert "Exchange" in p and "hashpartitioning(date_granularity" not in p
    after_rollup = p[:p.index("Generate inline")]
    assert "Exchange" not in after_rollup  # the roll-up and the join to the dimensions, on the fact side


@pytest.mark.parametrize("entity", ["ad", "keyword"])
def test_reports_from_sources_equal_those_from_staging(spark, entity):
    """NULL entities and key parts, conversions without report rows, repeated rows, several campaigns a keyword-day."""
    src = testdata.ad_sources(spark, SF)
    raw, conv = src.require(f"{entity}_report"), src.require(f"{entity}_conversions")
    n = F.col("clicks")
    raw = raw.withColumn(f"{entity}_id", F.when(n % 5 != 0, F.col(f"{entity}_id")))
    raw = raw.unionByName(raw.where(n == 2)).unionByName(raw.where(n == 3).withColumn("campaign_id", F.col("campaign_id") + 1000))
    raw = raw.withColumn("ad_group_id", F.when(n != 4, F.col("ad_group_id")))
    conv = conv.unionByName(conv.where(F.col("all_conversions") == 2).withColumn("date", F.date_add("date", 4000)))
    conv = conv.unionByName(conv.limit(20).withColumn(f"{entity}_id", F.lit(None).cast("long")))
    conv = conv.unionByName(conv.limit(20).withColumn("date", F.lit(None).cast("date")))
    src = src.with_(**{f"{entity}_report": raw, f"{entity}_conversions": conv})
    staging = (staging_ad if entity == "ad" else staging_keyword)(src, CFG, sync_time=False)
    got, want = report(entity, src, CFG), report(entity, src, CFG, staging=staging)
    assert got.schema.simpleString() == want.schema.simpleString()
    doubles = [f.name for f in got.schema if f.dataType.simpleString() == "double"]
    plain = lambda df: sorted(map(tuple, df.withColumns({c: F.round(c, 2) for c in doubles}).collect()), key=str)
    assert plain(got) == plain(want)
    assert got.where(F.col(f"{entity}_id").isNull()).count() > 0


def test_key_counts_within_an_entity_equal_plain_ones(spark, plain_plans):
    rows = [(1, "a"), (1, "a"), (1, None), (2, "b"), (None, None), (None, None), (3, "c"), (3, "c"), (3, "c")]
    df = spark.createDataFrame(rows, "ad_id long, unique_key string")
    assert checks.key_test_counts(df, within="ad_id").first() == checks.key_test_counts(df).first() == (5, 3)
    lying = df.where("ad_id IS NOT NULL").repartition(4, "ad_id")
    p = plain_plans(checks.key_test_counts(lying, within="ad_id"))
    assert "Exchange hashpartitioning(ad_id" in p and "hashpartitioning(ad_id" in p.split("Union")[1] and "hashpartitioning(ad_id#" in p
    assert "hashpartitioning(unique_key" not in p.split("isnotnull(ad_id")[0].split("Union")[-1]


def test_ids_of_text_are_counted_by_their_whole_key(spark):
    df = spark.createDataFrame([("x_1", "2", "k")], "ad_group_id string, ad_id string, unique_key string")
    assert checks._within("performance_by_ad", df) is None


def test_merge_since_joins_only_what_the_batch_may_replace(spark):
    day = dt.date
    target = spark.createDataFrame([(day(2024, 1, 1), 1, "old"), (day(2024, 2, 1), 1, "old"), (None, 1, "old"), (day(2024, 2, 1), None, "old")],
                                   "date date, id long, v string")
    batch = spark.createDataFrame([(day(2024, 2, 1), 1, "new"), (day(2024, 2, 1), None, "new")], "date date, id long, v string")
    for safe in (True, False):
        args = (target, batch, ["date", "id"], "append", safe)
        bound, whole = merge_by_key(*args, since=("date", day(2024, 1, 29))), merge_by_key(*args)
        assert sorted(map(str, bound.collect())) == sorted(map(str, whole.collect()))


def test_upsert_writes_older_rows_without_a_shuffle_and_drops_shuffle_files(spark, tmpdir_path, monkeypatch):
    from adcube.sinks import table
    day, path = dt.date, f"{tmpdir_path}/t"
    rows = [(g, day(2024, m, 1), i, "old") for g in ("day", "month") for m in range(1, 6) for i in (1, 2, None)]
    schema = "g string, date date, id long, v string"
    write_table(spark.createDataFrame(rows, schema), path, ("g",))
    batch = spark.createDataFrame([("day", day(2024, 5, 1), 1, "new"), ("month", day(2024, 6, 1), None, "new")], schema)
    seen, plain = [], table._write_beside
    monkeypatch.setattr(table, "_write_beside", lambda *a, **k: (seen.append((a, k)), plain(*a, **k))[1])
    assert upsert_by_key(spark, batch, path, ["g", "date", "id"], null_safe=True, partition_by=("g",), since=("date", day(2024, 5, 1))) == "upserted"
    as_is = seen[-1][0][4]
    assert "Exchange" not in as_is._jdf.queryExecution().executedPlan().toString().split("LeftSemi")[0].split("BroadcastExchange")[0]
    want = [r for r in rows if r[:3] != ("day", day(2024, 5, 1), 1)] + [("day", day(2024, 5, 1), 1, "new"), ("month", day(2024, 6, 1), None, "new")]
    found = read_table(spark, path).select("g", "date", "id", "v").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
