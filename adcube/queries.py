"""Registered queries: one per operator / model, over the driver's test tables.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
*whole* tables.  Doubles are rounded at the very end (money to 2 decimals,
ratios to 6) so the oracle comparison does not depend on summation order.
The matching DuckDB SQL lives in :mod:`adcube.oracle`.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType
from pyspark.sql.types import DoubleType

from .config import EngineConfig
from .functions.dates import date_part_columns
from .functions.naming import clean_goal_name_col
from .operators.facts import aggregate_day
from .operators.latest import latest_versions
from .operators.quality import not_null_violations, unique_violations
from .operators.currency import exchange_rates
from .operators.rollup import period_rollup
from .plans import dims
from .plans.columns import CAMPAIGN_RAW_EXCLUDE, KEYWORD_RAW_EXCLUDE
from .plans.incremental import report_batch, report_keys, report_since, run_report, run_staging, staging_batch, staging_keys
from .plans.reports import middle, report
from .plans.staging import goal_pivot, report_rows, staging_ad, staging_campaign, staging_keyword
from .session import ensure_checkpoint_dir
from .sinks import snapshot
from .sinks.table import merge_by_key, publish, read_table, write_table
from .sources import testdata
from .functions.classify import campaign_type

# Fixed test parameters (mirrored in adcube/oracle.py): the target tables of
# the incremental queries hold the data shipped up to FIRST_LOAD; the next run
# then sees the whole tables.
FIRST_LOAD = _dt.date(2000, 6, 30)
AS_OF = _dt.date(2001, 6, 30)

USD = EngineConfig()
STRICT = EngineConfig(strict=True)
EUR = EngineConfig(currency="EUR", as_of=AS_OF)
RATIO_COLUMNS = ("impression_share", "raw_rate", "exchange_rate")


def round_half_up(c, digits: int):
    """``floor(x * 10^d + 0.5) / 10^d`` in plain IEEE arithmetic.

    Spark's ``round`` rounds the shortest decimal *string* of a double, other
    engines the binary value; on exact decimal ties (money / 0.8) they differ.
    This formula gives identical doubles on any IEEE engine.
    """
    scale = float(10 ** digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def rounded(df: DataFrame) -> DataFrame:
    """Round double columns: ratios to 6 decimals, everything else (money) to 2."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, DoubleType):
            out[f.name] = round_half_up(F.col(f"`{f.name}`"), 6 if f.name in RATIO_COLUMNS else 2)
    return df.withColumns(out) if out else df


def _src(spark, sf_dir, **kw):
    return testdata.ad_sources(spark, sf_dir, **kw)


def _newest_day(src, name: str) -> _dt.date:
    """Newest day of a table built from ``src``: that of its report rows."""
    return src.require(name).agg(F.max("date")).first()[0]


# --------------------------------------------------------------------------- dimensions

def q_latest_versions_with_ties(spark, sf_dir):
    t = testdata.tables(spark, sf_dir, ["orders"])
    return latest_versions(testdata.history_with_ties(t), "id", "modified_time")


def _dim(fn):
    return lambda spark, sf_dir: rounded(fn(_src(spark, sf_dir)))


def q_campaign_type(spark, sf_dir):
    d = dims.dim_campaigns(_src(spark, sf_dir))
    return d.select("campaign_id", "campaign_name", campaign_type(F.col("campaign_name")).alias("campaign_type_default"))


# --------------------------------------------------------------------------- facts

def q_campaign_day_aggregate(spark, sf_dir):
    src = _src(spark, sf_dir)
    return rounded(aggregate_day(report_rows(src, "campaign_report", CAMPAIGN_RAW_EXCLUDE),
                                 ["date", "account_id", "campaign_id"]))


def q_keyword_day_aggregate(spark, sf_dir):
    src = _src(spark, sf_dir)
    return rounded(aggregate_day(report_rows(src, "keyword_report", KEYWORD_RAW_EXCLUDE),
                                 ["date", "account_id", "campaign_id", "ad_group_id", "keyword_id"]))


def _pivot(name, keys):
    def q(spark, sf_dir):
        src = _src(spark, sf_dir)
        return rounded(goal_pivot(src.require(name), keys, USD))
    return q


def q_goal_pivot_many(spark, sf_dir):
    """Two thousand goals: each key's columns, weighted by the goal's number and summed."""
    conv = _src(spark, sf_dir).require("keyword_conversions")
    number = (F.col("keyword_id") * 7 + F.col("ad_group_id") * 13) % 2000
    conv = conv.withColumn("goal", F.concat(F.lit("Goal no. "), number.cast("string")))
    keys = ["date", "ad_group_id", "keyword_id"]
    pivot = goal_pivot(conv, keys, USD, struct="goals")
    columns = pivot.schema["goals"].dataType.names
    numbers = [int(c.removeprefix("goalno")) + 1 for c in columns[::2]]

    def weigh(goals):  # column by column; nested, so that it travels by value
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        sums = [pa.array(np.zeros(len(goals), t)) for t in ("int64", "float64")]
        for i, number in enumerate(numbers):
            for k in (0, 1):
                x = pc.multiply_checked(goals.field(2 * i + k), pa.scalar(number, sums[k].type))
                sums[k] = pc.add_checked(sums[k], x)
        return pa.StructArray.from_arrays(sums, ["conversions", "revenue"])

    weighted = F.arrow_udf(weigh, "conversions long, revenue double", ArrowUDFType.SCALAR)("goals").alias("sums")
    return rounded(pivot.select(*keys, F.lit(len(columns)).cast("long").alias("n_columns"), weighted)
                   .select(*keys, "n_columns", "sums.*"))


def q_goal_columns(spark, sf_dir):
    conv = _src(spark, sf_dir).require("campaign_conversions")
    g = F.col("goal")
    found = conv.where(g.isNotNull() & (g != "")).groupBy("goal").agg(F.count(F.lit(1)).alias("n_rows"))
    name = clean_goal_name_col(F.col("goal"))
    return found.select("goal", name.alias("column_name"), F.concat(name, F.lit("_value")).alias("value_column"),
                        "n_rows")


def _staging(fn, **src_kw):
    return lambda spark, sf_dir: rounded(fn(_src(spark, sf_dir, **src_kw), USD))


def q_exchange_rates(spark, sf_dir):
    src = _src(spark, sf_dir)
    return rounded(exchange_rates(src.require("calendar"), src.require("currency"), "EUR", AS_OF))


def _middle(entity, cfg):
    return lambda spark, sf_dir: rounded(middle(entity, _src(spark, sf_dir), cfg))


def _date_parts(week_start):
    def q(spark, sf_dir):
        t = testdata.tables(spark, sf_dir, ["lineitem"])
        return testdata.calendar(t).select("date", *[c.alias(n) for n, c in
                                                     date_part_columns("date", week_start).items()])
    return q


def q_impression_share_rollup(spark, sf_dir):
    src = _src(spark, sf_dir)
    facts = report_rows(src, "campaign_report", CAMPAIGN_RAW_EXCLUDE).select(
        "date", "campaign_id", "impressions", "impression_share")
    return rounded(period_rollup(facts, ["campaign_id"], ["impressions", "impression_share"]))


def _ad_share(from_staging):
    """Ad report whose source has a share: ads and keywords sum it plainly."""
    def q(spark, sf_dir):
        src = _src(spark, sf_dir, ad_share=True)
        out = report("ad", src, USD, staging=staging_ad(src, USD) if from_staging else None)
        return rounded(out.select("date_granularity", "date", "ad_id", "impressions", "impression_share"))
    return q


# --------------------------------------------------------------------------- reports

def _report(entity, cfg=USD):
    return lambda spark, sf_dir: rounded(report(entity, _src(spark, sf_dir), cfg))


def q_report_by_campaign_sunday(spark, sf_dir):
    return rounded(report("campaign", _src(spark, sf_dir), USD.with_(week_start="Sunday")))


# --------------------------------------------------------------------------- incremental

def q_staging_incremental_window(spark, sf_dir):
    """Second daily run of campaign staging: re-stage max(date) - 31 onward, upsert (sync)."""
    first = _src(spark, sf_dir, max_date=str(FIRST_LOAD))
    batch = staging_batch("campaign", _src(spark, sf_dir), STRICT, _newest_day(first, "campaign_report"))
    return rounded(merge_by_key(staging_campaign(first, STRICT), batch, ["unique_key"], "sync"))


def _report_incremental(entity, cfg):
    def q(spark, sf_dir):
        first = _src(spark, sf_dir, max_date=str(FIRST_LOAD))
        second = _src(spark, sf_dir)
        newest = _newest_day(first, f"{entity}_report")
        batch = report_batch(entity, second, cfg, newest)
        return rounded(merge_by_key(report(entity, first, cfg), batch, report_keys(entity, cfg), "append",
                                    null_safe=not cfg.strict, since=report_since(newest, cfg)))
    return q


def _upsert_columns(policy):
    def q(spark, sf_dir):
        first = _src(spark, sf_dir, max_date=str(FIRST_LOAD))
        second = _src(spark, sf_dir, conversions=False)
        batch = staging_batch("campaign", second, USD, _newest_day(first, "campaign_report"))
        return rounded(merge_by_key(staging_campaign(first, USD), batch, staging_keys("campaign", USD), policy,
                                    null_safe=True))
    return q


# --------------------------------------------------------------------------- sinks

def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"


def q_sink_full_refresh(spark, sf_dir):
    """A table written twice holds the second content (partitions by account)."""
    path = _folder(spark)
    write_table(staging_campaign(_src(spark, sf_dir, max_date=str(FIRST_LOAD)), USD), path, ("account_id",))
    write_table(staging_campaign(_src(spark, sf_dir), USD), path, ("account_id",))
    return rounded(read_table(spark, path))


def q_sink_staging_runs(spark, sf_dir):
    """Two daily staging runs on disk, the second without conversion reports (columns synced)."""
    path = _folder(spark)
    run_staging(spark, "campaign", _src(spark, sf_dir, max_date=str(FIRST_LOAD)), USD, path, ("account_id",))
    run_staging(spark, "campaign", _src(spark, sf_dir, conversions=False), USD, path, ("account_id",))
    return rounded(read_table(spark, path))


def q_sink_report_runs(spark, sf_dir):
    """Two report runs on disk, columns appended, read back through the catalog."""
    path, table = _folder(spark), f"adcube_{uuid.uuid4().hex}"
    run_report(spark, "campaign", _src(spark, sf_dir, max_date=str(FIRST_LOAD)), USD, path, partition_by=("date_granularity",))
    run_report(spark, "campaign", _src(spark, sf_dir), USD, path, partition_by=("date_granularity",))
    publish(spark, path, table)
    return rounded(spark.table(table))


def q_sink_staging_days(spark, sf_dir):
    """Two daily staging runs in day partitions (the default); the second drops the goal columns
    and writes the days of its window only."""
    path = _folder(spark)
    run_staging(spark, "campaign", _src(spark, sf_dir, max_date=str(FIRST_LOAD)), USD, path)
    run_staging(spark, "campaign", _src(spark, sf_dir, conversions=False), USD, path)
    return rounded(read_table(spark, path))


def q_sink_report_days(spark, sf_dir):
    """Two report runs in (granularity, period) partitions, the default."""
    path = _folder(spark)
    run_report(spark, "campaign", _src(spark, sf_dir, max_date=str(FIRST_LOAD)), USD, path)
    run_report(spark, "campaign", _src(spark, sf_dir), USD, path)
    return rounded(read_table(spark, path))


def _database(spark) -> str:
    name = f"adcube_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{_folder(spark)}'")
    return name


def q_snapshot_staging_runs(spark, sf_dir):
    """Two daily staging runs into a catalog table whose readers see whole runs only."""
    table = f"{_database(spark)}.staging_campaign"
    run_staging(spark, "campaign", _src(spark, sf_dir, max_date=str(FIRST_LOAD)), USD, table, sink=snapshot)
    run_staging(spark, "campaign", _src(spark, sf_dir, conversions=False), USD, table, sink=snapshot)
    return rounded(spark.table(table))


def q_snapshot_report_runs(spark, sf_dir):
    """Two strict keyword report runs into such a table: rows with a NULL key accumulate, New Year's week is cut."""
    table = f"{_database(spark)}.performance_by_keyword"
    run_report(spark, "keyword", _src(spark, sf_dir, max_date=str(FIRST_LOAD)), STRICT, table, sink=snapshot)
    run_report(spark, "keyword", _src(spark, sf_dir), STRICT, table, sink=snapshot)
    return rounded(spark.table(table))


def q_sink_null_entities(spark, sf_dir):
    """Rows without an ad id: after two more exact runs the table equals a full refresh."""
    path = _folder(spark)
    run_report(spark, "ad", _src(spark, sf_dir, max_date=str(FIRST_LOAD), null_ids=True), USD, path, partition_by=("date_granularity",))
    for _ in range(2):
        run_report(spark, "ad", _src(spark, sf_dir, null_ids=True), USD, path, partition_by=("date_granularity",))
    return rounded(read_table(spark, path))


# --------------------------------------------------------------------------- quality

def q_quality_unique(spark, sf_dir):
    return unique_violations(staging_ad(_src(spark, sf_dir), USD), "unique_key")


def q_quality_missing_rates(spark, sf_dir):
    """Campaign-day rows per day whose money stays unconverted (EUR, as of AS_OF)."""
    from .operators.currency import unconverted_rows
    from .plans.reports import rates_for
    src = _src(spark, sf_dir)
    rows = unconverted_rows(staging_campaign(src, EUR), rates_for(src, EUR))
    return rows.groupBy("date").agg(F.count(F.lit(1)).alias("n_rows"))


def q_declared_tests(spark, sf_dir):
    from .plans.checks import declared_tests
    return declared_tests(_src(spark, sf_dir), USD)


def q_quality_not_null(spark, sf_dir):
    return rounded(not_null_violations(report("keyword", _src(spark, sf_dir), USD), "unique_key"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "latest_versions_with_ties": q_latest_versions_with_ties,
    "dim_accounts": _dim(dims.dim_accounts),
    "dim_campaigns": _dim(dims.dim_campaigns),
    "dim_ad_groups": _dim(dims.dim_ad_groups),
    "dim_ads": _dim(dims.dim_ads),
    "dim_keywords": _dim(dims.dim_keywords),
    "campaign_type": q_campaign_type,
    "campaign_day_aggregate": q_campaign_day_aggregate,
    "keyword_day_aggregate": q_keyword_day_aggregate,
    "goal_pivot_campaign": _pivot("campaign_conversions", ["date", "campaign_id"]),
    "goal_pivot_ad": _pivot("ad_conversions", ["date", "ad_id"]),
    "goal_pivot_keyword": _pivot("keyword_conversions", ["date", "ad_group_id", "keyword_id"]),
    "goal_columns": q_goal_columns,
    "goal_pivot_many": q_goal_pivot_many,
    "staging_campaign": _staging(staging_campaign),
    "staging_ad": _staging(staging_ad),
    "staging_keyword": _staging(staging_keyword),
    "staging_without_conversions": _staging(staging_campaign, conversions=False),
    "exchange_rates": q_exchange_rates,
    "middle_campaign_eur": _middle("campaign", EUR),
    "middle_ad_usd": _middle("ad", USD),
    "middle_keyword_eur": _middle("keyword", EUR),
    "date_parts_monday": _date_parts("Monday"),
    "date_parts_sunday": _date_parts("Sunday"),
    "impression_share_rollup": q_impression_share_rollup,
    "ad_share_from_sources": _ad_share(False),
    "ad_share_from_staging": _ad_share(True),
    "report_by_campaign": _report("campaign"),
    "report_by_ad": _report("ad"),
    "report_by_keyword": _report("keyword"),
    "report_by_campaign_eur": _report("campaign", EUR),
    "report_by_ad_eur": _report("ad", EUR),
    "report_by_campaign_sunday": q_report_by_campaign_sunday,
    "report_by_campaign_conversions_var": _report("campaign", USD.with_(conversion_measure="conversions")),
    "staging_incremental_window": q_staging_incremental_window,
    "report_incremental_reference": _report_incremental("campaign", STRICT),
    "report_incremental_exact": _report_incremental("campaign", USD),
    "upsert_sync_columns": _upsert_columns("sync"),
    "upsert_append_columns": _upsert_columns("append"),
    "upsert_null_keys": _report_incremental("keyword", STRICT),
    "upsert_entity_keys": _report_incremental("keyword", USD),
    "sink_full_refresh": q_sink_full_refresh,
    "sink_staging_runs": q_sink_staging_runs,
    "sink_report_runs": q_sink_report_runs,
    "sink_null_entities": q_sink_null_entities,
    "sink_staging_days": q_sink_staging_days,
    "sink_report_days": q_sink_report_days,
    "snapshot_staging_runs": q_snapshot_staging_runs,
    "snapshot_report_runs": q_snapshot_report_runs,
    "quality_unique": q_quality_unique,
    "quality_not_null": q_quality_not_null,
    "declared_tests": q_declared_tests,
    "quality_missing_rates": q_quality_missing_rates,
}
