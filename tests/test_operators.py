import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adcube.operators.currency import convert_money, exchange_rates
from adcube.operators.goals import discover_goals, pivot_goals
from adcube.operators.latest import latest_versions
from adcube.operators.quality import not_null_violations, unique_violations
from adcube.operators.rollup import period_rollup, period_rollup_union

D = dt.date


def ts(n):
    return None if n is None else dt.datetime(2024, 1, 1, 0, 0, n)


def test_latest_versions_keeps_ties_drops_null(spark):
    rows = [(1, "a", ts(1)), (1, "b", ts(2)), (2, "c", ts(3)), (2, "d", ts(3)), (3, "e", None)]
    df = spark.createDataFrame(rows, "id long, name string, modified_time timestamp_ntz")
    got = sorted((r.id, r.name) for r in latest_versions(df).collect())
    assert got == [(1, "b"), (2, "c"), (2, "d")]


def test_latest_versions_plan_limits_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("id"), F.timestamp_seconds(F.col("id")).cast("timestamp_ntz")
                                 .alias("modified_time"))
    plan = latest_versions(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def conv_fixture(spark):
    rows = [(D(2024, 1, 1), 10, "Sign Up", 1, 5.0), (D(2024, 1, 1), 10, "Sign Up", 2, 7.0),
            (D(2024, 1, 1), 10, "Buy (A/B)", 1, 20.0), (D(2024, 1, 2), 10, None, 4, 9.0),
            (D(2024, 1, 3), 11, "Buy (A/B)", None, 3.0)]
    return spark.createDataFrame(rows, "date date, campaign_id long, goal string, all_conversions long,"
                                       " all_revenue double")


def test_goal_pivot_and_left_join(spark):
    conv = conv_fixture(spark)
    goals = discover_goals(conv)
    assert sorted(goals) == ["Buy (A/B)", "Sign Up"]
    piv = pivot_goals(conv, ["date", "campaign_id"], goals, "all_conversions", "all_revenue")
    got = {(r.date, r.campaign_id): (r.signup, r.signup_value, r.buyab, r.buyab_value) for r in piv.collect()}
    assert got == {(D(2024, 1, 1), 10): (3, 12.0, 1, 20.0), (D(2024, 1, 2), 10): (0, 0.0, 0, 0.0),
                   (D(2024, 1, 3), 11): (0, 0.0, 0, 3.0)}
    facts = spark.createDataFrame([(D(2024, 1, 1), 10), (D(2024, 1, 2), 10), (D(2024, 1, 2), 11),
                                   (D(2024, 1, 3), 11)], "date date, campaign_id long")
    joined = {(r.date, r.campaign_id): r.signup for r in facts.join(piv, ["date", "campaign_id"], "left").collect()}
    assert joined[(D(2024, 1, 2), 11)] is None and joined[(D(2024, 1, 2), 10)] == 0


def test_calendar_rollup(spark):
    df = spark.createDataFrame([(D(2024, 12, 31), 1, 5), (D(2025, 1, 1), 1, 7), (D(2025, 1, 6), 1, 1)],
                               "date date, campaign_id long, clicks long")
    got = {(r.date_granularity, r.date): r.clicks for r in period_rollup(df, ["campaign_id"], ["clicks"]).collect()}
    assert got == {("day", D(2024, 12, 31)): 5, ("day", D(2025, 1, 1)): 7, ("day", D(2025, 1, 6)): 1,
                   ("week", D(2024, 12, 30)): 12, ("week", D(2025, 1, 6)): 1,
                   ("month", D(2024, 12, 1)): 5, ("month", D(2025, 1, 1)): 8,
                   ("quarter", D(2024, 10, 1)): 5, ("quarter", D(2025, 1, 1)): 8,
                   ("year", D(2024, 1, 1)): 5, ("year", D(2025, 1, 1)): 8}
    strict = {(r.date_granularity, r.date): r.clicks
              for r in period_rollup(df, ["campaign_id"], ["clicks"], since=D(2025, 1, 1)).collect()}
    assert strict[("week", D(2024, 12, 30))] == 7  # reference: the straddling week is truncated
    bounds = {g: D(2025, 1, 1) for g in ("day", "month", "quarter", "year")}
    bounds["week"] = D(2024, 12, 30)
    exact = {(r.date_granularity, r.date): r.clicks
             for r in period_rollup(df, ["campaign_id"], ["clicks"], since=bounds).collect()}
    assert exact[("week", D(2024, 12, 30))] == 12 and ("day", D(2024, 12, 31)) not in exact


def test_lagged_rate_and_conversion(spark):
    cal = spark.createDataFrame([(D(2024, 1, d),) for d in range(1, 5)], "date date")
    cur = spark.createDataFrame([(D(2024, 1, 1), 2.0), (D(2024, 1, 2), None), (D(2024, 1, 3), 4.0),
                                 (D(2024, 1, 4), None)], "date date, EUR double")
    rates = exchange_rates(cal, cur, "EUR", as_of=D(2024, 12, 31))
    got = {r.date: r.exchange_rate for r in rates.collect()}
    assert got == {D(2024, 1, 1): None, D(2024, 1, 2): 2.0, D(2024, 1, 3): 2.0, D(2024, 1, 4): 4.0}
    facts = spark.createDataFrame([(D(2024, 1, 1), 10.0), (D(2024, 1, 4), 10.0)], "date date, spend double")
    conv = {r.date: r.spend for r in convert_money(facts, rates).collect()}
    assert conv == {D(2024, 1, 1): None, D(2024, 1, 4): 2.5}
    cut = exchange_rates(cal, cur, "EUR", as_of=D(2024, 1, 2))
    assert cut.count() == 2


def test_weighted_share(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 1, 100, 0.5), (D(2024, 1, 1), 1, 50, None),
                                (D(2024, 1, 1), 1, 30, 0.0), (D(2024, 1, 1), 1, 60, 0.25),
                                (D(2024, 1, 1), 2, 10, None)],
                               "date date, campaign_id long, impressions long, impression_share double")
    out = period_rollup(df, ["campaign_id"], ["impressions", "impression_share"])
    got = {r.campaign_id: r.impression_share for r in out.where("date_granularity = 'day'").collect()}
    assert abs(got[1] - 190 / 440) < 1e-12 and got[2] == 0.0


day = st.dates(min_value=D(2023, 11, 1), max_value=D(2025, 2, 28))
fact_rows = st.lists(st.tuples(day, st.integers(1, 4), st.one_of(st.none(), st.integers(-50, 500))),
                     min_size=1, max_size=40)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=fact_rows)
def test_one_pass_equals_union_and_totals_agree(spark, rows):
    df = spark.createDataFrame(rows, "date date, campaign_id long, clicks long")
    a = period_rollup(df, ["campaign_id"], ["clicks"])
    b = period_rollup_union(df, ["campaign_id"], ["clicks"])
    ra = sorted(tuple(r) for r in a.collect())
    rb = sorted(tuple(r) for r in b.select(*a.columns).collect())
    assert ra == rb
    totals = {}
    for g, _, c, v in ra:
        totals.setdefault(c, {}).setdefault(g, 0)
        totals[c][g] += v
    for per_g in totals.values():
        assert len(set(per_g.values())) == 1  # every granularity sums to the same total


def test_quality_checks(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert [tuple(r) for r in unique_violations(df, "k").collect()] == [("a", 2)]
    assert not_null_violations(df, "k").count() == 2


goal_rows = st.lists(st.tuples(st.integers(0, 3), st.integers(1, 3),
                               st.sampled_from(["Sign Up", "Buy (A/B)", "", None]),
                               st.one_of(st.none(), st.integers(0, 9)), st.floats(0, 100, allow_nan=False)),
                     min_size=1, max_size=30)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=goal_rows)
def test_pivot_totals_equal_conversion_totals(spark, rows):
    conv = spark.createDataFrame([(D(2024, 1, 1 + d), c, g, m, v) for d, c, g, m, v in rows],
                                 "date date, campaign_id long, goal string, all_conversions long, all_revenue double")
    goals = [g for g in ("Sign Up", "Buy (A/B)") if any(r[2] == g for r in rows)]
    if not goals:
        return
    piv = pivot_goals(conv, ["date", "campaign_id"], goals, "all_conversions", "all_revenue").collect()
    names = {"Sign Up": "signup", "Buy (A/B)": "buyab"}
    for g in goals:
        want = sum(r[3] or 0 for r in rows if r[2] == g)
        want_v = sum(r[4] for r in rows if r[2] == g)
        assert sum(p[names[g]] for p in piv) == want
        assert abs(sum(p[names[g] + "_value"] for p in piv) - want_v) < 1e-6
    assert len(piv) == len({(r[0], r[1]) for r in rows})  # every key with any conversion row, goal or not


history_rows = st.lists(st.tuples(st.integers(1, 4), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 99)),
                        min_size=1, max_size=30)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=history_rows)
def test_latest_versions_is_newest_subset(spark, rows):
    df = spark.createDataFrame([(i, ts(t), v) for i, t, v in rows], "id long, modified_time timestamp_ntz, v long")
    got = sorted(tuple(r) for r in latest_versions(df).collect())
    newest = {}
    for i, t, _ in rows:
        if t is not None:
            newest[i] = max(newest.get(i, t), t)
    want = sorted((i, ts(t), v) for i, t, v in rows if t is not None and t == newest[i])
    assert got == want
