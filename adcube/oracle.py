"""Independent DuckDB SQL for every registered query (the correctness oracle).

Hand-written SQL over the driver's views (region, nation, supplier, part,
orders, lineitem).  It restates the test-data mapping of
``adcube.sources.testdata`` as CTEs and each model the way a warehouse would
run it: window ``max`` for latest versions, five GROUP BYs joined by UNION
ALL for the roll-up, ``lag(x ignore nulls)`` for rates, anti-join + union for
the keyed upsert.  Doubles are rounded (money 2, ratios 6) on both sides.
"""

from __future__ import annotations

# Fixed test-data values: goals present in the conversion stand-in and the
# column names they clean to; the first-load cut-off; the rate calendar's as-of day.
GOALS = (("1-URGENT", "1urgent"), ("2-HIGH", "2high"), ("3-MEDIUM", "3medium"),
         ("4-NOT SPECIFIED", "4notspecified"))
FIRST_LOAD = "2000-06-30"
AS_OF = "2001-06-30"
LOOKBACK = 31

MEASURES_INT = ("impressions", "clicks", "conversions", "all_conversions", "assists")
MEASURES_DBL = ("spend", "revenue", "all_revenue")
MEASURES = ("impressions", "clicks", "spend", "conversions", "all_conversions", "revenue",
            "all_revenue", "assists")
GOAL_INT = tuple(c for _, c in GOALS)
GOAL_DBL = tuple(f"{c}_value" for _, c in GOALS)


def q(name: str) -> str:
    return f'"{name}"'


# ----------------------------------------------------------------------------- sources

def perf_base(where: str = "", sfx: str = "") -> str:
    return f"""
perf_base{sfx} AS (
  SELECT CAST(l.l_shipdate AS DATE) AS date,
         CAST(n.n_regionkey AS BIGINT) AS account_id,
         CAST(s.s_nationkey AS BIGINT) AS campaign_id,
         l.l_suppkey AS ad_group_id, l.l_partkey AS keyword_id, l.l_orderkey AS ad_id,
         CAST(l.l_quantity AS BIGINT) AS impressions,
         CAST(l.l_linenumber AS BIGINT) AS clicks,
         l.l_extendedprice AS spend,
         CAST(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS conversions,
         CAST(1 AS BIGINT) AS all_conversions,
         l.l_extendedprice + l.l_quantity AS revenue,
         l.l_extendedprice + 2 * l.l_quantity AS all_revenue,
         CAST(CASE WHEN l.l_returnflag = 'A' THEN 1 ELSE 0 END AS BIGINT) AS assists,
         CASE WHEN l.l_linestatus = 'O' THEN 'USD' ELSE 'EUR' END AS currency_code,
         l.l_shipdate AS _fivetran_synced,
         CASE WHEN l.l_linestatus = 'F' THEN NULL ELSE l.l_discount * 100 END AS impression_share_percent,
         CASE WHEN l.l_linenumber % 2 = 0 THEN 'Computer' ELSE 'Smartphone' END AS device_type,
         'https://example.com/p/' || CAST(l.l_partkey AS VARCHAR) AS destination_url
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  {where}
)"""


def conv_base(where: str = "", sfx: str = "") -> str:
    cond = "WHERE l.l_returnflag = 'R'" + (f" AND {where}" if where else "")
    return f"""
conv_base{sfx} AS (
  SELECT CAST(l.l_shipdate AS DATE) AS date,
         CAST(s.s_nationkey AS BIGINT) AS campaign_id,
         l.l_orderkey AS ad_id, l.l_suppkey AS ad_group_id, l.l_partkey AS keyword_id,
         CASE WHEN o.o_orderpriority = '5-LOW' THEN NULL
              WHEN o.o_orderpriority = '3-MEDIUM' AND o.o_orderstatus = 'F' THEN ''
              ELSE o.o_orderpriority END AS goal,
         CAST(1 AS BIGINT) AS conversions,
         CAST(l.l_linenumber AS BIGINT) AS all_conversions,
         l.l_extendedprice AS revenue,
         l.l_extendedprice + l.l_quantity AS all_revenue
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  {cond}
)"""


def load_filter(max_date: str | None) -> str:
    return "" if max_date is None else f"WHERE CAST(l.l_shipdate AS DATE) <= DATE '{max_date}'"


def conv_filter(max_date: str | None) -> str:
    return "" if max_date is None else f"CAST(l.l_shipdate AS DATE) <= DATE '{max_date}'"


DIM_TS = "TIMESTAMP '2020-01-01 00:00:00'"

CAMPAIGN_NAME = """(CASE n_nationkey % 3 WHEN 0 THEN 'Search' WHEN 1 THEN 'Shopping' ELSE 'Display' END
   || ' - ' || CASE n_nationkey % 4 WHEN 0 THEN 'Brand' WHEN 1 THEN 'NonBrand' WHEN 2 THEN 'Unbranded'
   ELSE 'Generic' END || ' ' || n_name)"""

HISTORIES = f"""
account_history AS (
  SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name,
         CASE WHEN r_regionkey = 3 THEN 'EUR' ELSE 'USD' END AS currency_code,
         {DIM_TS} AS last_modified_time
  FROM region),
campaign_history AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, {CAMPAIGN_NAME} AS name,
         CAST((n_nationkey + 1) * 100 AS DOUBLE) AS budget,
         CASE WHEN n_regionkey = 0 THEN 'Paused' ELSE 'Active' END AS status,
         {DIM_TS} AS modified_time, CAST(n_regionkey AS BIGINT) AS account_id,
         'SearchAndContent' AS type
  FROM nation),
ad_group_history AS (
  SELECT s_suppkey AS id, s_name AS name,
         CASE WHEN s_acctbal < 0 THEN 'Paused' ELSE 'Active' END AS status,
         {DIM_TS} AS modified_time, CAST(s_nationkey AS BIGINT) AS campaign_id
  FROM supplier),
ad_history AS (
  SELECT o_orderkey AS id, 'Ad ' || o_orderpriority AS text, 'Text' AS type, 'Active' AS status,
         o_orderdate AS modified_time, o_custkey % 10 + 1 AS ad_group_id
  FROM orders
  UNION ALL
  SELECT o_orderkey, 'Ad ' || o_orderpriority || ' v2', 'Expanded', 'Archived',
         o_orderdate + INTERVAL 30 DAY, o_custkey % 7 + 1
  FROM orders WHERE o_orderstatus = 'F'),
keyword_history AS (
  SELECT p_partkey AS id, p_name AS name,
         CASE p_size % 3 WHEN 0 THEN 'Exact' WHEN 1 THEN 'Phrase' ELSE 'Broad' END AS match_type,
         'Active' AS status,
         CASE WHEN p_size > 45 THEN NULL ELSE {DIM_TS} END AS modified_time,
         p_partkey % 100 AS ad_group_id
  FROM part)"""


def _latest(hist: str, ts: str) -> str:
    return (f"(SELECT * FROM (SELECT *, MAX({ts}) OVER (PARTITION BY id) AS _newest FROM {hist}) "
            f"WHERE {ts} = _newest)")


DIMS = f"""
dim_accounts AS (
  SELECT id AS account_id, name AS account_name, currency_code AS account_currency_code, id AS unique_key
  FROM {_latest('account_history', 'last_modified_time')}),
dim_campaigns AS (
  SELECT id AS campaign_id, name AS campaign_name, budget AS campaign_budget, status AS campaign_status,
         account_id, type AS campaign_type, id AS unique_key
  FROM {_latest('campaign_history', 'modified_time')}),
dim_ad_groups AS (
  SELECT id AS ad_group_id, name AS ad_group_name, status AS ad_group_status, campaign_id, id AS unique_key
  FROM {_latest('ad_group_history', 'modified_time')}),
dim_ads AS (
  SELECT id AS ad_id, text AS ad_text, type AS ad_type, status AS ad_status, ad_group_id, id AS unique_key
  FROM {_latest('ad_history', 'modified_time')}),
dim_keywords AS (
  SELECT id AS keyword_id, name, match_type, status, ad_group_id, id AS unique_key
  FROM {_latest('keyword_history', 'modified_time')})"""

CAMPAIGN_TYPE = """CASE
    WHEN regexp_matches(campaign_name, 'search', 'i') AND regexp_matches(campaign_name, 'brand', 'i')
         AND NOT regexp_matches(campaign_name, 'unbranded|nonbrand', 'i') THEN 'Campaign Type: Search Branded'
    WHEN regexp_matches(campaign_name, 'search', 'i') AND regexp_matches(campaign_name, 'unbranded|nonbrand', 'i')
         THEN 'Campaign Type: Search Nonbrand'
    WHEN regexp_matches(campaign_name, 'search', 'i') THEN 'Campaign Type: Search'
    WHEN regexp_matches(campaign_name, 'shopping', 'i') AND regexp_matches(campaign_name, 'brand', 'i')
         AND NOT regexp_matches(campaign_name, 'unbranded|nonbrand', 'i') THEN 'Campaign Type: Shopping Branded'
    WHEN regexp_matches(campaign_name, 'shopping', 'i') AND regexp_matches(campaign_name, 'unbranded|nonbrand', 'i')
         THEN 'Campaign Type: Shopping Nonbrand'
    WHEN regexp_matches(campaign_name, 'shopping', 'i') THEN 'Campaign Type: Shopping'
    ELSE '' END"""

CALENDAR_AND_RATES = f"""
cal_bounds AS (SELECT CAST(MIN(l_shipdate) AS DATE) AS lo, CAST(MAX(l_shipdate) AS DATE) AS hi FROM lineitem),
calendar AS (SELECT CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM cal_bounds),
currency AS (
  SELECT CAST(o_orderdate AS DATE) AS date,
         CAST(0.501 AS DOUBLE) + CAST(MAX(o_orderkey) % 100 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS "EUR",
         CAST(0.701 AS DOUBLE) + CAST(MIN(o_orderkey) % 50 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS "GBP"
  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
rates AS (
  SELECT DISTINCT date, raw_rate, exchange_rate FROM (
    SELECT c.date, r."EUR" AS raw_rate,
           LAG(r."EUR" IGNORE NULLS) OVER (ORDER BY c.date) AS exchange_rate
    FROM calendar c LEFT JOIN currency r USING (date)
    WHERE c.date <= DATE '{AS_OF}'))"""


# ----------------------------------------------------------------------------- facts

def goal_pivot(name: str, keys: str, measure: str = "all_conversions", value: str = "all_revenue",
               sfx: str = "") -> str:
    cols = []
    for goal, col in GOALS:
        cols.append(f"CAST(COALESCE(SUM(CASE WHEN goal = '{goal}' THEN {measure} ELSE 0 END), 0) AS BIGINT) AS {q(col)}")
        cols.append(f"COALESCE(SUM(CASE WHEN goal = '{goal}' THEN {value} ELSE 0 END), 0) AS {q(col + '_value')}")
    return f"""
{name} AS (
  SELECT {keys}, {', '.join(cols)}
  FROM conv_base{sfx} GROUP BY {keys})"""


def day_agg(name: str, keys: str, sfx: str = "") -> str:
    sums = ", ".join(
        (f"CAST(SUM({m}) AS BIGINT) AS {m}" if m in MEASURES_INT else f"SUM({m}) AS {m}") for m in MEASURES)
    return f"""
{name} AS (
  SELECT {keys}, {sums}, MAX(currency_code) AS currency_code, MAX(_fivetran_synced) AS _fivetran_synced
  FROM perf_base{sfx} GROUP BY {keys})"""


def goal_cols(alias: str) -> str:
    return ", ".join(f"{alias}.{q(c)}, {alias}.{q(c + '_value')}" for _, c in GOALS)


def staging_campaign_cte(name="staging_campaign", since: str | None = None, conversions=True,
                         measure="all_conversions", value="all_revenue", sfx: str = "") -> str:
    where = "" if since is None else f"WHERE a.date >= ({since})"
    if conversions:
        pivot = goal_pivot(f"conv_campaign{sfx}", "date, campaign_id", measure, value, sfx) + ","
        body = f"""SELECT a.*, {goal_cols('c')},
         MAX(a._fivetran_synced) OVER (PARTITION BY a.account_id) AS last_updated,
         CAST(a.campaign_id AS VARCHAR) || '_' || CAST(a.date AS VARCHAR) AS unique_key
  FROM camp_agg{sfx} a LEFT JOIN conv_campaign{sfx} c ON a.date = c.date AND a.campaign_id = c.campaign_id
  {where}"""
    else:
        pivot = ""
        body = f"""SELECT a.*, MAX(a._fivetran_synced) OVER (PARTITION BY a.account_id) AS last_updated,
         CAST(a.campaign_id AS VARCHAR) || '_' || CAST(a.date AS VARCHAR) AS unique_key
  FROM camp_agg{sfx} a {where}"""
    return f"""{day_agg(f'camp_agg{sfx}', 'date, account_id, campaign_id', sfx)},{pivot}
{name} AS (
  {body})"""


def staging_ad_cte(name="staging_ad", since: str | None = None, sfx: str = "") -> str:
    where = "" if since is None else f"WHERE p.date >= ({since})"
    return f"""{goal_pivot(f'conv_ad{sfx}', 'date, ad_id', sfx=sfx)},
{name} AS (
  SELECT p.date, p.account_id, p.campaign_id, p.ad_group_id, p.ad_id,
         {', '.join('p.' + m for m in MEASURES)}, p.currency_code, p._fivetran_synced,
         p.device_type, p.destination_url, {goal_cols('c')},
         MAX(p._fivetran_synced) OVER (PARTITION BY p.account_id) AS last_updated,
         CAST(p.ad_id AS VARCHAR) || '_' || CAST(p.date AS VARCHAR) AS unique_key
  FROM perf_base{sfx} p LEFT JOIN conv_ad{sfx} c ON p.date = c.date AND p.ad_id = c.ad_id
  {where})"""


def staging_keyword_cte(name="staging_keyword", since: str | None = None, sfx: str = "") -> str:
    where = "" if since is None else f"WHERE a.date >= ({since})"
    return f"""{day_agg(f'kw_agg{sfx}', 'date, account_id, campaign_id, ad_group_id, keyword_id', sfx)},
{goal_pivot(f'conv_keyword{sfx}', 'date, ad_group_id, keyword_id', sfx=sfx)},
{name} AS (
  SELECT a.*, {goal_cols('c')},
         MAX(a._fivetran_synced) OVER (PARTITION BY a.account_id) AS last_updated,
         CAST(a.ad_group_id AS VARCHAR) || '_' || CAST(a.keyword_id AS VARCHAR) || '_' || CAST(a.date AS VARCHAR) AS unique_key
  FROM kw_agg{sfx} a LEFT JOIN conv_keyword{sfx} c
    ON a.date = c.date AND a.ad_group_id = c.ad_group_id AND a.keyword_id = c.keyword_id
  {where})"""


def _money(col: str, currency: bool) -> str:
    return f"CAST({q(col)} AS DOUBLE) / exchange_rate AS {q(col)}" if currency else f"CAST({q(col)} AS DOUBLE) AS {q(col)}"


def converted(name: str, staging: str, entity: str, currency: bool, since: str | None = None) -> str:
    keys = {"campaign": ["date", "campaign_id"], "ad": ["date", "ad_id"], "keyword": ["date", "keyword_id"]}[entity]
    cols = list(keys) + [m for m in MEASURES]
    for _, c in GOALS:
        cols += [c, c + "_value"]
    cols.append("last_updated")
    if entity == "ad":
        cols.append("destination_url")
    money = set(MEASURES_DBL) | set(GOAL_DBL)
    exprs = [_money(c, currency) if c in money else q(c) for c in cols]
    join = "LEFT JOIN rates USING (date)" if currency else ""
    where = "" if since is None else f"WHERE date >= ({since})"
    return f"""
{name} AS (
  SELECT {', '.join(exprs)} FROM {staging} {join} {where})"""


def date_parts(col: str = "date", week_start: str = "Monday") -> str:
    week = (f"CAST(date_trunc('week', {col}) AS DATE)" if week_start == "Monday"
            else f"{col} - CAST(dayofweek({col}) AS INTEGER)")
    return (f"{col} AS day, {week} AS week, CAST(date_trunc('month', {col}) AS DATE) AS month, "
            f"CAST(date_trunc('quarter', {col}) AS DATE) AS quarter, CAST(date_trunc('year', {col}) AS DATE) AS year")


def rollup(name: str, facts: str, dim: str, measures, int_measures, since_by_g=None) -> str:
    parts = []
    for g in ("day", "week", "month", "quarter", "year"):
        aggs = []
        for m in measures:
            if m in int_measures:
                aggs.append(f"CAST(COALESCE(SUM({q(m)}), 0) AS BIGINT) AS {q(m)}")
            else:
                aggs.append(f"COALESCE(SUM({q(m)}), 0) AS {q(m)}")
        where = "" if not since_by_g else f"WHERE date >= ({since_by_g[g]})"
        parts.append(f"SELECT '{g}' AS date_granularity, {g} AS date, {dim}, {', '.join(aggs)} "
                     f"FROM (SELECT *, {date_parts()} FROM {facts}) {where} GROUP BY 1, 2, 3")
    return f"""
{name} AS (
  {' UNION ALL '.join(parts)})"""


REPORT_MEASURES = MEASURES + tuple(c for _, c in GOALS for c in (c, c + "_value"))
REPORT_INT = set(MEASURES_INT) | set(GOAL_INT)

REPORT_TAIL = {
    "campaign": ("LEFT JOIN (SELECT campaign_id, campaign_name, campaign_budget, campaign_status, account_id, campaign_type FROM dim_campaigns) USING (campaign_id) "
                 "LEFT JOIN (SELECT account_id, account_name, account_currency_code FROM dim_accounts) USING (account_id)",
                 "CAST(date AS VARCHAR) || '_' || date_granularity || '_' || CAST(campaign_id AS VARCHAR)"),
    "ad": ("LEFT JOIN (SELECT ad_id, ad_text, ad_type, ad_status, ad_group_id FROM dim_ads) USING (ad_id) "
           "LEFT JOIN (SELECT ad_group_id, ad_group_name, ad_group_status, campaign_id FROM dim_ad_groups) USING (ad_group_id) "
           "LEFT JOIN (SELECT campaign_id, campaign_name, campaign_budget, campaign_status, account_id, campaign_type FROM dim_campaigns) USING (campaign_id) "
           "LEFT JOIN (SELECT account_id, account_name, account_currency_code FROM dim_accounts) USING (account_id)",
           "CAST(date AS VARCHAR) || '_' || date_granularity || '_' || CAST(ad_group_id AS VARCHAR) || '_' || CAST(ad_id AS VARCHAR)"),
    "keyword": ("LEFT JOIN (SELECT keyword_id, ad_group_id, name, match_type, status FROM dim_keywords) USING (keyword_id) "
                "LEFT JOIN (SELECT ad_group_id, ad_group_name, ad_group_status, campaign_id FROM dim_ad_groups) USING (ad_group_id) "
                "LEFT JOIN (SELECT campaign_id, campaign_name, campaign_budget, campaign_status, account_id, campaign_type FROM dim_campaigns) USING (campaign_id) "
                "LEFT JOIN (SELECT account_id, account_name, account_currency_code FROM dim_accounts) USING (account_id)",
                "CAST(date AS VARCHAR) || '_' || date_granularity || '_' || CAST(ad_group_id AS VARCHAR) || '_' || CAST(keyword_id AS VARCHAR)"),
}
ENTITY_DIM = {"campaign": "campaign_id", "ad": "ad_id", "keyword": "keyword_id"}


def report_select(rolled: str, entity: str) -> str:
    joins, key = REPORT_TAIL[entity]
    return f"""SELECT *, {CAMPAIGN_TYPE} AS campaign_type_default, {key} AS unique_key
FROM (SELECT * FROM {rolled} {joins})"""


def rounded(sql: str, money=(), ratio=()) -> str:
    def half_up(c, scale):  # floor(x * 10^d + 0.5) / 10^d, identical IEEE steps on both engines
        return (f"CAST(FLOOR({q(c)} * CAST({scale} AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS DOUBLE)"
                f" / CAST({scale} AS DOUBLE) AS {q(c)}")
    reps = [half_up(c, 100) for c in money] + [half_up(c, 1000000) for c in ratio]
    if not reps:
        return sql
    return f"SELECT * REPLACE ({', '.join(reps)}) FROM (\n{sql}\n)"


STAGING_MONEY = MEASURES_DBL + GOAL_DBL
REPORT_MONEY = STAGING_MONEY + ("campaign_budget",)


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n,") for c in ctes if c)


def staging_sources(max_date: str | None = None, sfx: str = "") -> list[str]:
    return [perf_base(load_filter(max_date), sfx), conv_base(conv_filter(max_date), sfx)]


STAGING_CTE = {"campaign": staging_campaign_cte, "ad": staging_ad_cte, "keyword": staging_keyword_cte}


def report_ctes(entity: str, *, currency: bool = False, max_date: str | None = None, sfx: str = "",
                measure: str = "all_conversions", value: str = "all_revenue",
                since_by_g: dict | None = None) -> list[str]:
    """CTEs ending in ``report{sfx}`` (histories, dims and rates must be added once)."""
    kw = dict(measure=measure, value=value) if entity == "campaign" else {}
    ctes = staging_sources(max_date, sfx) + [STAGING_CTE[entity](name=f"staging_{entity}{sfx}", sfx=sfx, **kw)]
    ctes.append(converted(f"facts{sfx}", f"staging_{entity}{sfx}", entity, currency))
    ctes.append(rollup(f"rolled{sfx}", f"facts{sfx}", ENTITY_DIM[entity], REPORT_MEASURES, REPORT_INT, since_by_g))
    ctes.append(f"\nreport{sfx} AS ({report_select(f'rolled{sfx}', entity)})")
    return ctes


def report_sql(entity: str, *, currency: bool = False, max_date: str | None = None,
               measure: str = "all_conversions", value: str = "all_revenue") -> str:
    ctes = [HISTORIES, DIMS] + ([CALENDAR_AND_RATES] if currency else [])
    ctes += report_ctes(entity, currency=currency, max_date=max_date, measure=measure, value=value)
    return rounded(with_(*ctes) + "\nSELECT * FROM report", money=REPORT_MONEY)


# ----------------------------------------------------------------------------- registry

def _select(ctes, body, money=(), ratio=()):
    return rounded(with_(*ctes) + "\n" + body, money=money, ratio=ratio)


def _dim_sql(name, money=()):
    return _select([HISTORIES, DIMS], f"SELECT * FROM {name}", money=money)


LATEST_WITH_TIES = """
WITH hist AS (SELECT o_custkey AS id, o_orderkey AS version_id, o_orderstatus AS status,
                     o_orderdate AS modified_time FROM orders)
SELECT id, version_id, status, modified_time
FROM (SELECT *, MAX(modified_time) OVER (PARTITION BY id) AS newest FROM hist)
WHERE modified_time = newest"""


def _pivot_sql(name, keys):
    return _select([conv_base(), goal_pivot(name, keys)], f"SELECT * FROM {name}", money=GOAL_DBL)


GOAL_COLUMNS = _select([conv_base()], """SELECT goal,
       translate(lower(goal), '().&- !:/+|<>', '') AS column_name,
       translate(lower(goal), '().&- !:/+|<>', '') || '_value' AS value_column,
       CAST(COUNT(*) AS BIGINT) AS n_rows
FROM conv_base WHERE goal IS NOT NULL AND goal <> '' GROUP BY goal""")


GOAL_PIVOT_MANY = _select([conv_base()], """SELECT date, ad_group_id, keyword_id,
       2 * (SELECT COUNT(DISTINCT (keyword_id * 7 + ad_group_id * 13) % 2000) FROM conv_base) AS n_columns,
       CAST(SUM(((keyword_id * 7 + ad_group_id * 13) % 2000 + 1) * all_conversions) AS BIGINT) AS conversions,
       SUM(((keyword_id * 7 + ad_group_id * 13) % 2000 + 1) * all_revenue) AS revenue
FROM conv_base GROUP BY 1, 2, 3""", money=("revenue",))


def _staging_sql(entity, **kw):
    ctes = staging_sources() + [STAGING_CTE[entity](**kw)]
    return _select(ctes, f"SELECT * FROM staging_{entity}", money=STAGING_MONEY if kw.get("conversions", True)
                   else MEASURES_DBL)


def _middle_sql(entity, currency):
    ctes = staging_sources() + [STAGING_CTE[entity]()] + ([CALENDAR_AND_RATES] if currency else [])
    ctes.append(converted("facts", f"staging_{entity}", entity, currency))
    return _select(ctes, f"SELECT *, {date_parts()} FROM facts", money=STAGING_MONEY)


def _date_parts_sql(week_start):
    return with_(CALENDAR_AND_RATES) + f"\nSELECT date, {date_parts('date', week_start)} FROM calendar"


IMPRESSION_SHARE = _select([perf_base(), """
share_facts AS (SELECT date, campaign_id, impressions,
                       CAST(impression_share_percent AS DOUBLE) / CAST(100.0 AS DOUBLE) AS impression_share
                FROM perf_base)""", "\nshare_rolled AS (" + " UNION ALL ".join(
    f"""SELECT '{g}' AS date_granularity, {g} AS date, campaign_id,
       CAST(COALESCE(SUM(impressions), 0) AS BIGINT) AS impressions,
       COALESCE(CAST(SUM(CASE WHEN impression_share IS NOT NULL THEN impressions ELSE 0 END) AS DOUBLE)
                / NULLIF(SUM(COALESCE(CAST(impressions AS DOUBLE) / NULLIF(CAST(impression_share AS DOUBLE), 0), 0)), 0), 0)
         AS impression_share
FROM (SELECT *, {date_parts()} FROM share_facts) GROUP BY 1, 2, 3""" for g in ("day", "week", "month", "quarter", "year")) + ")"],
    "SELECT * FROM share_rolled", ratio=("impression_share",))


def _report_sunday_sql():
    sql = report_sql("campaign")
    return sql.replace(date_parts(), date_parts("date", "Sunday"))


STAGING_WINDOW = _select(
    staging_sources(FIRST_LOAD, "_t") + [staging_campaign_cte(name="target", sfx="_t")]
    + staging_sources(None, "_b")
    + [staging_campaign_cte(name="batch", sfx="_b", since=f"(SELECT MAX(date) - {LOOKBACK} FROM target)")],
    """SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.unique_key = t.unique_key)
UNION ALL SELECT * FROM batch""", money=STAGING_MONEY)


def _upsert_columns_sql(policy):
    ctes = (staging_sources(FIRST_LOAD, "_t") + [staging_campaign_cte(name="target", sfx="_t")]
            + staging_sources(None, "_b")
            + [staging_campaign_cte(name="batch", sfx="_b", conversions=False,
                                    since=f"(SELECT MAX(date) - {LOOKBACK} FROM target)")])
    kept = "FROM target t WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.unique_key = t.unique_key)"
    if policy == "append":
        body = f"SELECT * {kept} UNION ALL BY NAME SELECT * FROM batch"
        return _select(ctes, body, money=STAGING_MONEY)
    body = f"SELECT t.* EXCLUDE ({', '.join(q(c) for c in GOAL_INT + GOAL_DBL)}) {kept} UNION ALL SELECT * FROM batch"
    return _select(ctes, body, money=MEASURES_DBL)


def _report_incremental_sql(entity, exact, strict_keys=True):
    """Both loads from one staging chain: a day row counts for the first load, the next run, or both.

    Rows of the first load stay where the next run has none of their key (a NULL key has none).
    """
    weeks = "CAST(date_trunc('week', w) AS DATE)" if exact else "w"
    periods = ", ".join(f"{{'g': '{g}', 'd': {d}}}" for g, d in (
        ("day", "date"), *((g, f"CAST(date_trunc('{g}', date) AS DATE)") for g in ("week", "month", "quarter", "year"))))
    sums = ", ".join(f"CAST(COALESCE(SUM({q(m)}), 0) AS BIGINT) AS {q(m)}" if m in REPORT_INT
                     else f"COALESCE(SUM({q(m)}), 0) AS {q(m)}" for m in REPORT_MEASURES)
    dim = ENTITY_DIM[entity]
    ctes = [HISTORIES, DIMS, *staging_sources(), STAGING_CTE[entity](),
            converted("facts", f"staging_{entity}", entity, False),
            f"""
bound AS (SELECT w, {weeks} AS first_week FROM (
  SELECT CAST(date_trunc('year', MAX(CAST(l_shipdate AS DATE)) - {LOOKBACK}) AS DATE) AS w
  FROM lineitem l {load_filter(FIRST_LOAD)}))""",
            f"""
rolled AS (
  SELECT load, p.g AS date_granularity, p.d AS date, {dim}, {sums}
  FROM (SELECT *, unnest([{periods}]) AS p FROM facts) d, bound, (VALUES ('first'), ('next')) v(load)
  WHERE CASE WHEN load = 'first' THEN d.date <= DATE '{FIRST_LOAD}'
             ELSE d.date >= CASE WHEN p.g = 'week' THEN first_week ELSE w END END
  GROUP BY 1, 2, 3, 4)"""]
    key = "unique_key" if strict_keys else f"date_granularity, date, {dim}"
    no_key = "OR unique_key IS NULL" if strict_keys else ""
    body = f"""SELECT * EXCLUDE (load) FROM ({report_select('rolled', entity)})
QUALIFY load = 'next' {no_key} OR COUNT(*) FILTER (WHERE load = 'next') OVER (PARTITION BY {key}) = 0"""
    return _select(ctes, body, money=REPORT_MONEY)


def _null_ids(sql: str) -> str:
    """The same over sources whose rows of every fifth line number have no ad id."""
    return sql.replace("l.l_orderkey AS ad_id", "CASE WHEN l.l_linenumber % 5 <> 0 THEN l.l_orderkey END AS ad_id")


AD_SHARE = _select([perf_base()], " UNION ALL ".join(
    f"""SELECT '{g}' AS date_granularity, {g} AS date, ad_id, CAST(SUM(impressions) AS BIGINT) AS impressions,
       COALESCE(SUM(CAST(impression_share_percent AS DOUBLE) / CAST(100.0 AS DOUBLE)), 0) AS impression_share
FROM (SELECT *, {date_parts()} FROM perf_base) GROUP BY 1, 2, 3""" for g in ("day", "week", "month", "quarter", "year")),
    ratio=("impression_share",))


QUALITY_UNIQUE = with_(*(staging_sources() + [staging_ad_cte()])) + """
SELECT unique_key, CAST(COUNT(*) AS BIGINT) AS n_records FROM staging_ad
WHERE unique_key IS NOT NULL GROUP BY unique_key HAVING COUNT(*) > 1"""


def _quality_not_null_sql():
    ctes = [HISTORIES, DIMS] + report_ctes("keyword")
    return _select(ctes, "SELECT * FROM report WHERE unique_key IS NULL", money=REPORT_MONEY)


def _declared_tests_sql():
    ctes = [HISTORIES, DIMS] + report_ctes("campaign", sfx="_c") + report_ctes("ad", sfx="_a")
    models = [("accounts", "dim_accounts", True), ("campaigns", "dim_campaigns", True),
              ("staging_campaign", "staging_campaign_c", True), ("performance_by_campaign", "report_c", False),
              ("ad_groups", "dim_ad_groups", True), ("ads", "dim_ads", True),
              ("staging_ad", "staging_ad_a", True), ("performance_by_ad", "report_a", False)]
    parts = []
    for model, rel, not_null in models:
        parts.append(f"""SELECT '{model}' AS model, 'unique_key' AS column_name, 'unique' AS test,
       CAST(COALESCE((SELECT SUM(n) FROM (SELECT COUNT(*) AS n FROM {rel} WHERE unique_key IS NOT NULL
                      GROUP BY unique_key HAVING COUNT(*) > 1)), 0) AS BIGINT) AS failures""")
        if not_null:
            parts.append(f"""SELECT '{model}', 'unique_key', 'not_null',
       CAST((SELECT COUNT(*) FROM {rel} WHERE unique_key IS NULL) AS BIGINT)""")
    return with_(*ctes) + "\n" + "\nUNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    return {
        "latest_versions_with_ties": LATEST_WITH_TIES,
        "dim_accounts": _dim_sql("dim_accounts"),
        "dim_campaigns": _dim_sql("dim_campaigns", money=("campaign_budget",)),
        "dim_ad_groups": _dim_sql("dim_ad_groups"),
        "dim_ads": _dim_sql("dim_ads"),
        "dim_keywords": _dim_sql("dim_keywords"),
        "campaign_type": with_(HISTORIES, DIMS) + f"\nSELECT campaign_id, campaign_name, {CAMPAIGN_TYPE} AS campaign_type_default FROM dim_campaigns",
        "campaign_day_aggregate": _select([perf_base(), day_agg("camp_agg", "date, account_id, campaign_id")],
                                          "SELECT * FROM camp_agg", money=MEASURES_DBL),
        "keyword_day_aggregate": _select([perf_base(), day_agg("kw_agg", "date, account_id, campaign_id, ad_group_id, keyword_id")],
                                         "SELECT * FROM kw_agg", money=MEASURES_DBL),
        "goal_pivot_campaign": _pivot_sql("conv_campaign", "date, campaign_id"),
        "goal_pivot_ad": _pivot_sql("conv_ad", "date, ad_id"),
        "goal_pivot_keyword": _pivot_sql("conv_keyword", "date, ad_group_id, keyword_id"),
        "goal_columns": GOAL_COLUMNS,
        "goal_pivot_many": GOAL_PIVOT_MANY,
        "staging_campaign": _staging_sql("campaign"),
        "staging_ad": _staging_sql("ad"),
        "staging_keyword": _staging_sql("keyword"),
        "staging_without_conversions": _staging_sql("campaign", conversions=False),
        "exchange_rates": _select([CALENDAR_AND_RATES], "SELECT * FROM rates", ratio=("raw_rate", "exchange_rate")),
        "middle_campaign_eur": _middle_sql("campaign", True),
        "middle_ad_usd": _middle_sql("ad", False),
        "middle_keyword_eur": _middle_sql("keyword", True),
        "date_parts_monday": _date_parts_sql("Monday"),
        "date_parts_sunday": _date_parts_sql("Sunday"),
        "impression_share_rollup": IMPRESSION_SHARE,
        "ad_share_from_sources": AD_SHARE,
        "ad_share_from_staging": AD_SHARE,
        "report_by_campaign": report_sql("campaign"),
        "report_by_ad": report_sql("ad"),
        "report_by_keyword": report_sql("keyword"),
        "report_by_campaign_eur": report_sql("campaign", currency=True),
        "report_by_ad_eur": report_sql("ad", currency=True),
        "report_by_campaign_sunday": _report_sunday_sql(),
        "report_by_campaign_conversions_var": report_sql("campaign", measure="conversions", value="revenue"),
        "staging_incremental_window": STAGING_WINDOW,
        "report_incremental_reference": _report_incremental_sql("campaign", exact=False),
        "report_incremental_exact": _report_incremental_sql("campaign", exact=True),
        "upsert_sync_columns": _upsert_columns_sql("sync"),
        "upsert_append_columns": _upsert_columns_sql("append"),
        "upsert_null_keys": _report_incremental_sql("keyword", exact=False),
        "upsert_entity_keys": _report_incremental_sql("keyword", exact=True, strict_keys=False),
        "sink_full_refresh": _staging_sql("campaign"),
        "sink_staging_runs": _upsert_columns_sql("sync"),
        "sink_report_runs": report_sql("campaign"),
        "sink_null_entities": _null_ids(report_sql("ad")),
        "sink_staging_days": _upsert_columns_sql("sync"),
        "sink_report_days": report_sql("campaign"),
        "snapshot_staging_runs": _upsert_columns_sql("sync"),
        "snapshot_report_runs": _report_incremental_sql("keyword", exact=False),
        "quality_unique": QUALITY_UNIQUE,
        "quality_not_null": _quality_not_null_sql(),
        "declared_tests": _declared_tests_sql(),
        "quality_missing_rates": with_(*(staging_sources() + [staging_campaign_cte(), CALENDAR_AND_RATES])) + """
SELECT s.date, CAST(COUNT(*) AS BIGINT) AS n_rows FROM staging_campaign s
WHERE NOT EXISTS (SELECT 1 FROM rates r WHERE r.date = s.date AND r.exchange_rate IS NOT NULL)
GROUP BY s.date""",
    }
