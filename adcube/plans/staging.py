"""Day-grain staging facts: performance + pivoted goals + sync time + key."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.keys import surrogate_key
from ..functions.naming import clean_columns
from ..operators.enrich import left_join
from ..operators.facts import aggregate_day, with_last_updated
from ..operators.goals import discover_goals, pivot_goals
from ..sources.catalog import SOURCE_TABLES, AdSources
from .columns import AD_RAW_EXCLUDE, CAMPAIGN_RAW_EXCLUDE, CONVERSION_FIELDS, KEYWORD_RAW_EXCLUDE


def goals_for(conversions: DataFrame | None, cfg: EngineConfig) -> list[str]:
    if conversions is None:
        return []
    return list(cfg.goals) if cfg.goals is not None else discover_goals(conversions, cfg.max_goals)


def goal_pivot(conversions: DataFrame | None, keys: list[str], cfg: EngineConfig,
               existing=(), struct: str | None = None) -> DataFrame | None:
    """Goal pivot at ``keys`` grain, or ``None`` if there is no report or no goal."""
    goals = goals_for(conversions, cfg)
    if not goals:
        return None
    conv = conversions.select(*keys, *CONVERSION_FIELDS)
    return pivot_goals(conv, keys, goals, cfg.conversion_measure, cfg.conversion_value, existing, struct)


def _since(df: DataFrame, since: _dt.date | None) -> DataFrame:
    return df if since is None else df.where(F.col("date") >= F.lit(since).cast("date"))


def report_rows(src: AdSources, name: str, exclude, cfg: EngineConfig | None = None) -> DataFrame:
    """Raw report rows without the excluded columns, renamed."""
    raw = src.require(name)
    extra = () if cfg is None else cfg.extra_exclude
    return raw.select(*clean_columns(SOURCE_TABLES[name], raw.columns, (*exclude, *extra)))


def staging_campaign(src: AdSources, cfg: EngineConfig, since: _dt.date | None = None,
                     sync_time: bool = True) -> DataFrame:
    """Campaign-day facts: summed measures ⟕ goal pivot on (date, campaign_id).

    ``since`` is the incremental cut (``date >= since``); Catalyst pushes it
    into both scans, through the aggregate and across the join key.
    """
    insights = _since(report_rows(src, "campaign_report", CAMPAIGN_RAW_EXCLUDE, cfg), since)
    join_keys = ["date", "campaign_id"]
    agg = aggregate_day(insights, ["date", "account_id", "campaign_id"], cluster_by=join_keys)
    piv = goal_pivot(src.campaign_conversions, join_keys, cfg, agg.columns)
    rows = agg if piv is None else agg.join(piv, join_keys, "left")
    if sync_time:  # max over raw rows == max over the day aggregate; avoids re-aggregating
        rows = with_last_updated(rows, insights)
    return rows.withColumn("unique_key", surrogate_key("campaign_id", "date"))


def ad_insights(src: AdSources, cfg: EngineConfig | None = None) -> DataFrame:
    """Ad report rows minus the excluded rate columns, renamed."""
    return report_rows(src, "ad_report", AD_RAW_EXCLUDE, cfg)


def staging_ad(src: AdSources, cfg: EngineConfig, since: _dt.date | None = None,
               sync_time: bool = True) -> DataFrame:
    """Ad report rows (not aggregated) ⟕ goal pivot on (date, ad_id).

    Like the reference, segment rows of one ad-day each receive the ad-day's
    goal totals (see README, "fan-out"); ``quality`` checks expose it.
    """
    insights = _since(ad_insights(src, cfg), since)
    piv = goal_pivot(src.ad_conversions, ["date", "ad_id"], cfg, insights.columns)
    rows = insights if piv is None else left_join(insights, piv, ["date", "ad_id"])
    if sync_time:
        rows = with_last_updated(rows, insights)
    return rows.withColumn("unique_key", surrogate_key("ad_id", "date"))


def staging_keyword(src: AdSources, cfg: EngineConfig, since: _dt.date | None = None,
                    sync_time: bool = True) -> DataFrame:
    """Keyword-day facts; both sides are aggregated to keyword grain before the join.

    ``sync_time=False`` omits ``last_updated`` (reports never read it).
    """
    keys = ["date", "account_id", "campaign_id", "ad_group_id", "keyword_id"]
    insights = _since(report_rows(src, "keyword_report", KEYWORD_RAW_EXCLUDE, cfg), since)
    join_keys = ["date", "ad_group_id", "keyword_id"]
    agg = aggregate_day(insights, keys, cluster_by=join_keys)
    piv = goal_pivot(src.keyword_conversions, join_keys, cfg, agg.columns)
    rows = agg if piv is None else agg.join(piv, join_keys, "left")
    if sync_time:
        rows = with_last_updated(rows, insights)
    return rows.withColumn("unique_key", surrogate_key("ad_group_id", "keyword_id", "date"))


STAGING = {"campaign": staging_campaign, "ad": staging_ad, "keyword": staging_keyword}
