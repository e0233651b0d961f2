"""Currency-converted day facts ("middle" tables) and multi-granularity reports."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import GRANULARITIES, EngineConfig
from ..functions.classify import campaign_type
from ..functions.dates import date_part_columns, week_start_date
from ..functions.keys import surrogate_key
from ..operators.currency import convert_money, exchange_rates
from ..functions.naming import goal_columns
from ..operators.enrich import by_entity, enrich, unmatched
from ..operators.facts import DAY_MEASURES
from ..operators.goals import WIDE
from ..operators.rollup import measure_columns, period_rollup
from ..session import written
from ..sources.catalog import AdSources
from .columns import (AD_FACT_EXCLUDE, AD_MEASURE_EXCLUDE, CAMPAIGN_FACT_EXCLUDE,
                      CAMPAIGN_MEASURE_EXCLUDE, KEYWORD_FACT_EXCLUDE, KEYWORD_MEASURE_EXCLUDE,
                      KEYWORD_RAW_EXCLUDE)
from .dims import hierarchy
from .staging import STAGING, ad_insights, goal_pivot, goals_for, report_rows


@dataclass(frozen=True)
class ReportSpec:
    fact_exclude: tuple[str, ...]
    measure_exclude: tuple[str, ...]
    dimension: str
    key: tuple[str, ...]
    weighted_share: bool = False


REPORTS = {
    "campaign": ReportSpec(CAMPAIGN_FACT_EXCLUDE, CAMPAIGN_MEASURE_EXCLUDE, "campaign_id",
                           ("date", "date_granularity", "campaign_id"), weighted_share=True),
    "ad": ReportSpec(AD_FACT_EXCLUDE, AD_MEASURE_EXCLUDE, "ad_id",
                     ("date", "date_granularity", "ad_group_id", "ad_id")),
    "keyword": ReportSpec(KEYWORD_FACT_EXCLUDE, KEYWORD_MEASURE_EXCLUDE, "keyword_id",
                          ("date", "date_granularity", "ad_group_id", "keyword_id")),
}


def rates_for(src: AdSources, cfg: EngineConfig) -> DataFrame | None:
    """Lagged exchange rates for a non-USD reporting currency, else ``None`` (÷1).

    One row per calendar day, written once so that its size is known.  A day
    with two rates would fan every fact row of that day out: the run fails
    there, except in strict mode, where the fan-out is the reference's.
    """
    if not cfg.converts_currency:
        return None
    rates = exchange_rates(src.require("calendar"), src.require("currency"), cfg.currency, cfg.as_of)
    if not cfg.strict:
        twice = F.raise_error(F.concat(F.lit("exchange-rate calendar has duplicate dates: "), F.col("date").cast("string")))
        rates = (rates.groupBy("date")
                 .agg(F.max("raw_rate").alias("raw_rate"), F.max("exchange_rate").alias("exchange_rate"),
                      F.count(F.lit(1)).alias("n"))
                 .select("date", "raw_rate", F.when(F.col("n") > 1, twice.cast("double"))
                         .otherwise(F.col("exchange_rate")).alias("exchange_rate")))
    return written(rates)


def report_table_name(entity: str, cfg: EngineConfig) -> str:
    """Report table name, prefixed with the configured namespace (target database)."""
    base = f"performance_by_{entity}"
    return f"{cfg.namespace}_{base}" if cfg.namespace else base


def converted_facts(staging: DataFrame, entity: str, src: AdSources, cfg: EngineConfig) -> DataFrame:
    """Staging minus the fact exclude list, money columns converted."""
    spec = REPORTS[entity]
    fields = [c for c in staging.columns if c not in spec.fact_exclude]
    return convert_money(staging.select(*fields), rates_for(src, cfg))


def middle(entity: str, src: AdSources, cfg: EngineConfig, staging: DataFrame | None = None) -> DataFrame:
    """Day-grain converted fact with ``day, week, month, quarter, year`` period starts."""
    stg = staging if staging is not None else STAGING[entity](src, cfg)
    return converted_facts(stg, entity, src, cfg).withColumns(date_part_columns("date", cfg.week_start))


def report_bounds(window_start: _dt.date, cfg: EngineConfig, exact: bool):
    """Per-granularity first source day of an incremental report run.

    strict (reference): every granularity reads from ``window_start`` (1 Jan),
    which truncates the week straddling New Year.  exact: weeks read from the
    start of that week; the other periods nest inside the year.
    """
    if not exact:
        return window_start
    bounds = {g: window_start for g in GRANULARITIES}
    bounds["week"] = week_start_date(window_start, cfg.week_start)
    return bounds


def ad_day_facts(src: AdSources, cfg: EngineConfig) -> DataFrame:
    """Ad staging reduced to (date, ad_id) grain, for reports built straight from sources.

    The report only sums staging rows, and ad staging attaches the ad-day goal
    totals to every segment row.  Summing raw measures per ad-day and scaling
    the goal totals by the ad-day's row count gives the same sums, but the raw
    report is combined map-side instead of being shuffled row by row for the
    goal join.  (A materialized staging table is passed as ``staging=`` and
    read as is.)
    """
    spec = REPORTS["ad"]
    insights = ad_insights(src, cfg)
    skip = set(spec.fact_exclude) | set(spec.measure_exclude) | {spec.dimension}
    base = measure_columns(insights, insights.columns, skip)
    day = insights.groupBy("date", "ad_id").agg(*[F.sum(c).alias(c) for c in base],
                                                F.count(F.lit(1)).alias("_rows"))
    piv = goal_pivot(src.ad_conversions, ["date", "ad_id"], cfg, insights.columns)
    if piv is not None:
        goals = [c for c in piv.columns if c not in ("date", "ad_id")]
        day = day.join(piv, ["date", "ad_id"], "left").withColumns({c: F.col(c) * F.col("_rows") for c in goals})
    return day.drop("_rows")


# Entities that there are many of, with the keys of their goals and the rest of the grain of
# their day facts: their reports are built where each one's rows lie.
MANY = {"ad": (["date", "ad_id"], []),
        "keyword": (["date", "ad_group_id", "keyword_id"], ["account_id", "campaign_id"])}


def _day_rows(entity: str, src: AdSources, cfg: EngineConfig, goals: list[str], known: bool) -> DataFrame:
    """Day facts of the entities (``known``: lying by entity; else of rows without one).

    The sums that the goal join gives, without a join: report and conversion rows are
    sent to the entity's partition together, once, and summed there.  A goal total
    counts once for every fact row that it would be joined to, as in ad and keyword
    staging; conversions with a NULL key match none.
    """
    spec, (keys, finer) = REPORTS[entity], MANY[entity]
    conv = getattr(src, f"{entity}_conversions")
    if entity == "ad":
        raw = ad_insights(src, cfg)
        existing = raw.columns
        base = measure_columns(raw, raw.columns, {*spec.fact_exclude, *spec.measure_exclude, spec.dimension})
    else:
        raw = report_rows(src, "keyword_report", KEYWORD_RAW_EXCLUDE, cfg)
        existing = ["date", *finer, *keys[1:], *DAY_MEASURES, "currency_code", "_fivetran_synced"]
        base = [m for m in DAY_MEASURES if m not in spec.fact_exclude]
    rows = raw.select(*keys, *finer, *base, F.lit(False).alias("_conv"))
    named = goal_columns(goals, existing) if goals else []
    if named:
        conv = conv.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
        conv = conv.select(*keys, F.lit(True).alias("_conv"), F.col("goal").alias("_goal"),
                           F.col(cfg.conversion_measure).alias("_measure"), F.col(cfg.conversion_value).alias("_value"))
        rows = rows.unionByName(conv, allowMissingColumns=True)
    rows = by_entity(rows, spec.dimension) if known else rows.where(F.col(spec.dimension).isNull())
    sums = [F.sum(m).alias(m) for m in base]
    n_rows = F.sum(F.when(F.col("_conv"), 0).otherwise(1)).alias("_rows")
    totals = [F.coalesce(F.sum(F.when(F.col("_goal") == F.lit(goal), F.col(c)).otherwise(F.lit(0))), F.lit(0)).alias(n)
              for goal, *names in named for n, c in zip(names, ("_measure", "_value"))]
    names = [n for _, *pair in named for n in pair]
    if finer:
        groups = rows.groupBy(*keys, *finer, "_conv").agg(*sums, *totals)
        day = groups.groupBy(*keys).agg(*sums, n_rows, *[F.sum(F.when(F.col("_conv"), F.col(n))).cast(groups.schema[n].dataType).alias(n) for n in names])
    else:
        day = rows.groupBy(*keys).agg(*sums, n_rows, *totals)
    day = day.where(F.col("_rows") > 0).withColumns({n: F.col(n) * F.col("_rows") for n in names})
    return day.select("date", spec.dimension, *base, *names)


def _facts_by_entity(entity: str, src: AdSources, cfg: EngineConfig, staging: DataFrame | None) -> list[DataFrame]:
    """Converted facts of known entities, lying by entity, and those without one.

    The raw rows of an entity (or its staging rows) go to one partition once, at most one
    per day and segment; the roll-up and the dimension join follow there.  Rows without
    an entity, however many, are combined map-side.
    """
    spec, rates = REPORTS[entity], rates_for(src, cfg)
    if staging is None:
        goals = goals_for(getattr(src, f"{entity}_conversions"), cfg)
        if len(goals) <= WIDE:
            return [convert_money(_day_rows(entity, src, cfg, goals, known), rates) for known in (True, False)]
        cfg = cfg.with_(goals=tuple(goals))
        staging = ad_day_facts(src, cfg) if entity == "ad" else STAGING[entity](src, cfg, sync_time=False)
    rows = staging.select(*[c for c in staging.columns if c not in spec.fact_exclude])
    return [convert_money(r, rates) for r in (by_entity(rows, spec.dimension), rows.where(F.col(spec.dimension).isNull()))]


def report(entity: str, src: AdSources, cfg: EngineConfig, staging: DataFrame | None = None,
           window_start: _dt.date | None = None, exact: bool | None = None) -> DataFrame:
    """Performance by ``entity`` at all five granularities, enriched with the hierarchy.

    ``window_start`` turns the run incremental (only periods from there on are
    rebuilt, and only their entities are looked up in the histories); ``exact``
    defaults to ``not cfg.strict``.
    """
    spec = REPORTS[entity]
    if entity in MANY:
        parts = _facts_by_entity(entity, src, cfg, staging)
    else:
        # built here, staging skips last_updated: reports never read it
        stg = staging if staging is not None else STAGING[entity](src, cfg, sync_time=False)
        parts = (converted_facts(stg, entity, src, cfg),)
    since = ids = None
    if window_start is not None:
        exact = (not cfg.strict) if exact is None else exact
        since = report_bounds(window_start, cfg, exact)
        lowest = min(since.values()) if isinstance(since, dict) else since
        parts = [p.where(F.col("date") >= F.lit(lowest).cast("date")) for p in parts]  # prunes the scan
        ids = parts[0].select(spec.dimension)
        if entity in MANY:  # the same ids, without laying the rows out for them
            rows = staging if staging is not None else src.require(f"{entity}_report")
            ids = rows.where(F.col("date") >= F.lit(lowest).cast("date")).select(spec.dimension)
    measures = measure_columns(parts[0], parts[0].columns, spec.measure_exclude, [spec.dimension])
    rolled = [period_rollup(p, [spec.dimension], measures, cfg.week_start, since=since,
                            weighted_share_measure=spec.weighted_share) for p in parts]
    dims = hierarchy(src, entity, cfg, ids)
    if entity in MANY:
        known, unknown = rolled
        out = known.join(dims, spec.dimension, "left").unionByName(unmatched(unknown, dims, spec.dimension))
    else:
        out = enrich(rolled[0], dims, spec.dimension)
    return (out.withColumn("campaign_type_default", campaign_type(F.col("campaign_name")))
            .withColumn("unique_key", surrogate_key(*spec.key)))


def report_by_campaign(src: AdSources, cfg: EngineConfig, **kw) -> DataFrame:
    return report("campaign", src, cfg, **kw)


def report_by_ad(src: AdSources, cfg: EngineConfig, **kw) -> DataFrame:
    return report("ad", src, cfg, **kw)


def report_by_keyword(src: AdSources, cfg: EngineConfig, **kw) -> DataFrame:
    return report("keyword", src, cfg, **kw)
