"""The goal pivot with few and with many goals."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adcube.operators import goals


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def conversions(spark, n):
    names = ["It's a \\ goal", 'say "hi"', "back`tick", *(f"G {k}" for k in range(n))]
    data = [(k % 7 if k % 11 else None, k % 3, names[k * k % len(names)] if k % 5 else [None, "", "unlisted"][k % 3],
             k if k % 4 else None, k / 4, Decimal(k) / 8) for k in range(400)]
    return names, spark.createDataFrame(data, "day long, ad_id long, goal string, conversions long, revenue double, cost decimal(12,3)")


@pytest.mark.parametrize("value", ["revenue", "cost"])
@pytest.mark.parametrize("n", [3, 60])
def test_sums_side_by_side_and_from_the_map_are_the_same(spark, monkeypatch, n, value):
    names, conv = conversions(spark, n)
    out = []
    for wide in (0, 10**6):
        monkeypatch.setattr(goals, "WIDE", wide)
        out.append(goals.pivot_goals(conv, ["day", "ad_id"], names, "conversions", value))
    assert out[0].schema == out[1].schema and rows(out[0]) == rows(out[1])
    assert len(out[0].columns) == 2 + 2 * len(names)


def test_partial_rows_of_many_goals_are_narrow(spark):
    names, conv = conversions(spark, 200)
    sums = goals.sparse_goal_sums(conv, ["day", "ad_id"], names, "conversions", "revenue")
    p = sums._jdf.queryExecution().executedPlan().toString()
    assert p.count("partial_sum") == 2 and "_sums" in sums.columns
    # A hot key is combined before the first exchange, and its map has one entry a goal at most.
    hot = conv.withColumn("day", F.lit(1).cast("long")).withColumn("ad_id", F.lit(1).cast("long"))
    one = goals.sparse_goal_sums(hot, ["day", "ad_id"], names, "conversions", "revenue").collect()
    assert len(one) == 1 and len(one[0]["_sums"]) <= len(names)


def test_a_key_without_known_goals_reads_zero(spark, monkeypatch):
    monkeypatch.setattr(goals, "WIDE", 0)
    conv = spark.createDataFrame([(1, None, 5, 1.0), (2, "x", None, None), (2, "y", 3, 2.0)], "day long, goal string, conversions long, revenue double")
    assert rows(goals.pivot_goals(conv, ["day"], ["x", "y"], "conversions", "revenue")) == [(1, 0, 0.0, 0, 0.0), (2, 0, 0.0, 3, 2.0)]


@pytest.mark.parametrize("value", ["revenue", "cost"])
@pytest.mark.parametrize("wide", [0, 10**6])
def test_a_struct_has_the_same_goals_as_the_columns(spark, monkeypatch, wide, value):
    names, conv = conversions(spark, 60)
    columns = goals.pivot_goals(conv, ["day", "ad_id"], names, "conversions", value)
    monkeypatch.setattr(goals, "WIDE", wide)
    monkeypatch.setattr(goals, "CELLS", 500)  # a few rows at a time
    assert rows(goals.pivot_goals(conv, ["day", "ad_id"], names, "conversions", value)) == rows(columns)
    struct = goals.pivot_goals(conv, ["day", "ad_id"], names, "conversions", value, struct="goals")
    assert struct.columns == ["day", "ad_id", "goals"] and rows(struct.select("day", "ad_id", "goals.*")) == rows(columns)


def test_thousands_of_goals_are_filled_and_read_in_one_python_step(spark):
    """No expression for each goal: looking up 4,000 cells of a key one by one took milliseconds."""
    def total(row):
        return row.field(0)

    names, conv = conversions(spark, 2000)
    struct = goals.pivot_goals(conv, ["day", "ad_id"], names, "conversions", "revenue", struct="goals")
    first = F.arrow_udf(total, "long")("goals")
    p = struct.select("day", "ad_id", first.alias("first"))._jdf.queryExecution().executedPlan().toString()
    assert p.count("ArrowEvalPython") == 1 and "total(row(" in p
    wide = goals.pivot_goals(conv, ["day", "ad_id"], names, "conversions", "revenue")
    p = wide._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in p and p.count("coalesce") < 10
