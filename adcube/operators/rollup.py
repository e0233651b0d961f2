"""Period roll-up: day/week/month/quarter/year totals per entity in one table."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..config import GRANULARITIES
from ..functions.dates import period_start
from ..functions.keys import share_denominator, share_numerator, weighted_share

SHARE_MEASURE = "impression_share"


def measure_columns(df: DataFrame, candidates, exclude=(), dimensions=()) -> list[str]:
    """Columns of ``candidates`` that are summed: all minus excluded and dimensions.

    Non-numeric leftovers are an error (summing a string column would fail
    deep inside the job), reported with their names.
    """
    skip = set(exclude) | set(dimensions)
    measures = [c for c in candidates if c not in skip]
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    bad = [c for c in measures if not isinstance(types[c], NumericType)]
    if bad:
        raise TypeError(f"non-numeric columns would be summed: {bad}; add them to the exclude list")
    return measures


def _lower_bound(since, granularity: str) -> Column | None:
    if since is None:
        return None
    value = since.get(granularity) if isinstance(since, dict) else since
    return None if value is None else F.lit(value).cast("date")


def period_rollup(df: DataFrame, dimensions: list[str], measures: list[str],
                  week_start: str = "Monday", since=None, weighted_share_measure: bool = True) -> DataFrame:
    """``(date_granularity, date=period start, *dimensions, Σ measures)`` for all 5 granularities.

    One scan: each day row is tagged with its five (granularity, period)
    pairs through ``inline`` and a single ``groupBy`` sums them, with partial
    aggregation before the shuffle absorbing the 5x expansion.  Sums are
    ``COALESCE(SUM(m), 0)``.  ``impression_share`` is the impression-weighted
    share (numerator and denominator are summed separately and divided last),
    or, without ``weighted_share_measure``, a plain sum like the others.

    ``since`` limits the source days read per granularity: a date, or a
    ``{granularity: date}`` dict (used by the exact incremental mode to read
    whole weeks).
    """
    share = weighted_share_measure and SHARE_MEASURE in measures
    plain = [m for m in measures if not (share and m == SHARE_MEASURE)]
    cols: list[Column] = [F.col(d) for d in dimensions] + [F.col(m) for m in plain]
    if share:
        imp, sh = F.col("impressions"), F.col(SHARE_MEASURE)
        cols += [share_numerator(imp, sh).alias("_share_num"), share_denominator(imp, sh).alias("_share_den")]
    d = F.col("date")
    structs = []
    for g in GRANULARITIES:
        fields = [F.lit(g).alias("date_granularity"), period_start(d, g, week_start).alias("_period")]
        if since is not None:
            bound = _lower_bound(since, g)
            fields.append((F.lit(True) if bound is None else d >= bound).alias("_in_window"))
        structs.append(F.struct(*fields))
    exploded = df.select(*cols, F.inline(F.array(*structs)))
    if since is not None:
        exploded = exploded.where("_in_window")
    aggs = [F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in plain]
    if share:
        aggs += [F.sum("_share_num").alias("_share_num"), F.sum("_share_den").alias("_share_den")]
    out = exploded.groupBy("date_granularity", F.col("_period").alias("date"), *dimensions).agg(*aggs)
    if share:
        out = (out.withColumn(SHARE_MEASURE, weighted_share(F.col("_share_num"), F.col("_share_den")))
               .drop("_share_num", "_share_den"))
    return out.select("date_granularity", "date", *dimensions, *measures)


def period_rollup_union(df: DataFrame, dimensions: list[str], measures: list[str],
                        week_start: str = "Monday") -> DataFrame:
    """Reference-shaped roll-up: one aggregate per granularity, then UNION ALL.

    Kept as the equivalence baseline for :func:`period_rollup` (it scans the
    input once per granularity).
    """
    parts = []
    for g in GRANULARITIES:
        aggs = []
        for m in measures:
            if m == SHARE_MEASURE:
                imp, sh = F.col("impressions"), F.col(SHARE_MEASURE)
                aggs.append(weighted_share(F.sum(share_numerator(imp, sh)),
                                           F.sum(share_denominator(imp, sh))).alias(m))
            else:
                aggs.append(F.coalesce(F.sum(m), F.lit(0)).alias(m))
        part = (df.groupBy(F.lit(g).alias("date_granularity"),
                           period_start(F.col("date"), g, week_start).alias("date"), *dimensions)
                .agg(*aggs))
        parts.append(part)
    return reduce(lambda a, b: a.unionByName(b), parts)


def report_window_start(max_date: _dt.date, lookback_days: int) -> _dt.date:
    """First day re-read by an incremental report run: 1 Jan of (max date - lookback)."""
    return _dt.date((max_date - _dt.timedelta(days=lookback_days)).year, 1, 1)
