"""Day-grain fact operators: entity-day aggregation and the per-account sync time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

# The measures summed by the campaign and keyword staging facts.
DAY_MEASURES = ("impressions", "clicks", "spend", "conversions", "all_conversions",
                "revenue", "all_revenue", "assists")


def aggregate_day(insights: DataFrame, keys: list[str], cluster_by: list[str] | None = None) -> DataFrame:
    """Sum the fixed measures per ``keys``; greatest currency code and sync time.

    Aggregating *before* the goal join keeps segment rows (device, network, ...)
    from multiplying the goal totals.

    ``max`` over a string has no fixed-width buffer, so Spark would plan a
    sort-based aggregate over every raw row.  The currency code is therefore
    made a grouping key of a first, hash-based aggregate (map-side combine,
    no sort); the string max then runs over one row per (keys, currency).

    ``cluster_by`` (a subset of ``keys``, e.g. the goal-join keys) is the
    partitioning of that second level: the same exchange then also serves the
    join that follows, instead of a second shuffle of the day rows.
    """
    pre = insights.groupBy(*keys, "currency_code").agg(
        *[F.sum(m).alias(m) for m in DAY_MEASURES], F.max("_fivetran_synced").alias("_fivetran_synced"))
    if cluster_by:
        pre = pre.repartition(*cluster_by)
    return pre.groupBy(*keys).agg(
        *[F.sum(m).alias(m) for m in DAY_MEASURES],
        F.max("currency_code").alias("currency_code"),
        F.max("_fivetran_synced").alias("_fivetran_synced"))


def with_last_updated(rows: DataFrame, source: DataFrame,
                      partition_col: str = "account_id", ts_col: str = "_fivetran_synced",
                      out_col: str = "last_updated") -> DataFrame:
    """Add ``max(ts_col) over (partition by partition_col)`` to ``rows``.

    ``source`` is any relation holding the same (partition, ts) pairs as
    ``rows`` (max ignores duplicates), typically the pre-join side.  Written
    as aggregate + null-safe join instead of a window: a window would put all
    rows of one account in one task, while the aggregate combines map-side and
    has one row per account.  That result is written once, so the planner sees
    its size in bytes and broadcasts it below
    ``spark.sql.autoBroadcastJoinThreshold``.  NULL accounts form one group, as
    they do in a window partition.
    """
    per = (source.groupBy(F.col(partition_col).alias("_lu_key"))
           .agg(F.max(ts_col).alias(out_col)))
    per = written(per)
    return (rows.join(per, rows[partition_col].eqNullSafe(per["_lu_key"]), "left")
            .drop("_lu_key"))
