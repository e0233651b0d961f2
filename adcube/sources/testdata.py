"""Stand-ins for the ad model built from the driver's TPC-H-style tables.

The reference ships no data, so every raw source is derived by Spark from the
given tables (its size grows with them).  The same expressions are written
independently as SQL in ``adcube/oracle.py``.

=====================  ===================================================
ad model               derived from
=====================  ===================================================
performance reports    lineitem ⋈ supplier ⋈ nation (one row per line)
conversion reports     lineitem ⋈ orders ⋈ supplier, returned lines only
account_history        region
campaign_history       nation (names cover every campaign-type branch)
ad_group_history       supplier
ad_history             orders, plus a later version of every finished order
keyword_history        part; large parts carry a NULL modified time
calendar               every day between the first and last ship date
currency               days with urgent orders: EUR and GBP rates
=====================  ===================================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import AdSources

# Fixed timestamp stamped on single-version dimension rows.
DIM_TIMESTAMP = "2020-01-01 00:00:00"


def _ts(text: str) -> Column:
    return F.to_timestamp_ntz(F.lit(text))


def tables(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    names = names or ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def _perf_base(t: dict[str, DataFrame]) -> DataFrame:
    """One performance row per line item, with every key and measure of the model."""
    li = t["lineitem"]
    sup = t["supplier"].select("s_suppkey", "s_nationkey")
    nat = t["nation"].select("n_nationkey", "n_regionkey")
    j = li.join(sup, li.l_suppkey == sup.s_suppkey).join(nat, F.col("s_nationkey") == nat.n_nationkey)
    returned = F.col("l_returnflag") == "R"
    return j.select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("n_regionkey").cast("long").alias("account_id"),
        F.col("s_nationkey").cast("long").alias("campaign_id"),
        F.col("l_suppkey").alias("ad_group_id"),
        F.col("l_partkey").alias("keyword_id"),
        F.col("ad_id" if "ad_id" in li.columns else "l_orderkey").alias("ad_id"),
        F.col("l_quantity").cast("long").alias("impressions"),
        F.col("l_linenumber").cast("long").alias("clicks"),
        F.col("l_extendedprice").alias("spend"),
        F.when(returned, 1).otherwise(0).cast("long").alias("conversions"),
        F.lit(1).cast("long").alias("all_conversions"),
        (F.col("l_extendedprice") + F.col("l_quantity")).alias("revenue"),
        (F.col("l_extendedprice") + 2 * F.col("l_quantity")).alias("all_revenue"),
        F.when(F.col("l_returnflag") == "A", 1).otherwise(0).cast("long").alias("assists"),
        F.when(F.col("l_linestatus") == "O", "USD").otherwise("EUR").alias("currency_code"),
        F.col("l_shipdate").alias("_fivetran_synced"),
        F.when(F.col("l_linestatus") == "F", F.lit(None).cast("double"))
        .otherwise(F.col("l_discount") * 100).alias("impression_share_percent"),
        F.col("l_tax").alias("ctr"),
        F.when(F.col("l_linenumber") % 2 == 0, "Computer").otherwise("Smartphone").alias("device_type"),
        F.concat(F.lit("https://example.com/p/"), F.col("l_partkey").cast("string")).alias("destination_url"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("_fivetran_id"),
        F.when(F.col("l_linestatus") == "O", "Active").otherwise("Paused").alias("keyword_status"),
    )


MEASURES = ("impressions", "clicks", "spend", "conversions", "all_conversions",
            "revenue", "all_revenue", "assists")


def campaign_report(t) -> DataFrame:
    return _perf_base(t).select(
        "date", "account_id", "campaign_id", *MEASURES, "currency_code", "_fivetran_synced",
        "impression_share_percent", "ctr", "_fivetran_id")


def ad_report(t, share: bool = False) -> DataFrame:
    return _perf_base(t).select(
        "date", "account_id", "campaign_id", "ad_group_id", "ad_id", *MEASURES,
        "currency_code", "_fivetran_synced", "device_type", "destination_url", "ctr",
        *(["impression_share_percent"] if share else []))


def keyword_report(t) -> DataFrame:
    return _perf_base(t).select(
        "date", "account_id", "campaign_id", "ad_group_id", "keyword_id", *MEASURES,
        "currency_code", "_fivetran_synced", "device_type", "keyword_status", "ctr")


def _conversions(t) -> DataFrame:
    li = t["lineitem"].where(F.col("l_returnflag") == "R")
    o = t["orders"].select("o_orderkey", "o_orderpriority", "o_orderstatus")
    sup = t["supplier"].select("s_suppkey", "s_nationkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(sup, li.l_suppkey == sup.s_suppkey)
    goal = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
            .when((F.col("o_orderpriority") == "3-MEDIUM") & (F.col("o_orderstatus") == "F"), F.lit(""))
            .otherwise(F.col("o_orderpriority")))
    return j.select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("s_nationkey").cast("long").alias("campaign_id"),
        F.col("ad_id" if "ad_id" in li.columns else "l_orderkey").alias("ad_id"),
        F.col("l_suppkey").alias("ad_group_id"),
        F.col("l_partkey").alias("keyword_id"),
        goal.alias("goal"),
        F.lit(1).cast("long").alias("conversions"),
        F.col("l_linenumber").cast("long").alias("all_conversions"),
        F.col("l_extendedprice").alias("revenue"),
        (F.col("l_extendedprice") + F.col("l_quantity")).alias("all_revenue"),
    )


CONV_MEASURES = ("goal", "conversions", "all_conversions", "revenue", "all_revenue")


def campaign_conversions(t) -> DataFrame:
    return _conversions(t).select("date", "campaign_id", *CONV_MEASURES)


def ad_conversions(t) -> DataFrame:
    return _conversions(t).select("date", "ad_id", *CONV_MEASURES)


def keyword_conversions(t) -> DataFrame:
    return _conversions(t).select("date", "ad_group_id", "keyword_id", *CONV_MEASURES)


def account_history(t) -> DataFrame:
    return t["region"].select(
        F.col("r_regionkey").cast("long").alias("id"),
        F.col("r_name").alias("name"),
        F.when(F.col("r_regionkey") == 3, "EUR").otherwise("USD").alias("currency_code"),
        _ts(DIM_TIMESTAMP).alias("last_modified_time"),
    )


def campaign_name(nationkey: Column, nation_name: Column) -> Column:
    channel = (F.when(nationkey % 3 == 0, "Search").when(nationkey % 3 == 1, "Shopping")
               .otherwise("Display"))
    brand = (F.when(nationkey % 4 == 0, "Brand").when(nationkey % 4 == 1, "NonBrand")
             .when(nationkey % 4 == 2, "Unbranded").otherwise("Generic"))
    return F.concat(channel, F.lit(" - "), brand, F.lit(" "), nation_name)


def campaign_history(t) -> DataFrame:
    n = t["nation"]
    return n.select(
        F.col("n_nationkey").cast("long").alias("id"),
        campaign_name(F.col("n_nationkey"), F.col("n_name")).alias("name"),
        ((F.col("n_nationkey") + 1) * 100).cast("double").alias("budget"),
        F.when(F.col("n_regionkey") == 0, "Paused").otherwise("Active").alias("status"),
        _ts(DIM_TIMESTAMP).alias("modified_time"),
        F.col("n_regionkey").cast("long").alias("account_id"),
        F.lit("SearchAndContent").alias("type"),
    )


def ad_group_history(t) -> DataFrame:
    return t["supplier"].select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_acctbal") < 0, "Paused").otherwise("Active").alias("status"),
        _ts(DIM_TIMESTAMP).alias("modified_time"),
        F.col("s_nationkey").cast("long").alias("campaign_id"),
    )


def ad_history(t) -> DataFrame:
    o = t["orders"]
    first = o.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Ad "), F.col("o_orderpriority")).alias("text"),
        F.lit("Text").alias("type"),
        F.lit("Active").alias("status"),
        F.col("o_orderdate").alias("modified_time"),
        (F.col("o_custkey") % 10 + 1).alias("ad_group_id"),
    )
    later = o.where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Ad "), F.col("o_orderpriority"), F.lit(" v2")).alias("text"),
        F.lit("Expanded").alias("type"),
        F.lit("Archived").alias("status"),
        (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("modified_time"),
        (F.col("o_custkey") % 7 + 1).alias("ad_group_id"),
    )
    return first.unionByName(later)


def keyword_history(t) -> DataFrame:
    p = t["part"]
    return p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") % 3 == 0, "Exact").when(F.col("p_size") % 3 == 1, "Phrase")
        .otherwise("Broad").alias("match_type"),
        F.lit("Active").alias("status"),
        F.when(F.col("p_size") > 45, F.lit(None).cast("timestamp_ntz"))
        .otherwise(_ts(DIM_TIMESTAMP)).alias("modified_time"),
        (F.col("p_partkey") % 100).alias("ad_group_id"),
    )


def calendar(t) -> DataFrame:
    """Dense calendar over the ship-date range (one row per day)."""
    bounds = t["lineitem"].agg(F.min("l_shipdate").cast("date").alias("lo"),
                               F.max("l_shipdate").cast("date").alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("date"))


def currency(t) -> DataFrame:
    """Rates on days with urgent orders only, so the calendar has gaps.

    Rates end in ...1 (0.501 + k/100): money with 2 decimals divided by such a
    rate never lands exactly on a rounding tie, so two engines summing in
    different orders still round converted money to the same cent.
    """
    o = t["orders"].where(F.col("o_orderpriority") == "1-URGENT")
    return (o.groupBy(F.col("o_orderdate").cast("date").alias("date"))
            .agg((F.lit(0.501) + (F.max("o_orderkey") % 100) / 100.0).alias("EUR"),
                 (F.lit(0.701) + (F.min("o_orderkey") % 50) / 100.0).alias("GBP")))


def history_with_ties(t) -> DataFrame:
    """A history table whose ids have many versions and some tied timestamps."""
    return t["orders"].select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderkey").alias("version_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("modified_time"),
    )


def ad_sources(spark: SparkSession, sf_dir: str, *, conversions: bool = True,
               max_date: str | None = None, null_ids: bool = False, ad_share: bool = False) -> AdSources:
    """All sources of the ad model; ``max_date`` cuts facts to simulate an earlier load.

    ``null_ids``: report and conversion rows of every fifth line number have no
    ad id.  ``ad_share``: the ad report has a share column.
    """
    t = tables(spark, sf_dir)
    if null_ids:
        t["lineitem"] = t["lineitem"].withColumn(
            "ad_id", F.when(F.col("l_linenumber") % 5 != 0, F.col("l_orderkey")))
    facts = dict(
        campaign_report=campaign_report(t), ad_report=ad_report(t, ad_share), keyword_report=keyword_report(t),
        campaign_conversions=campaign_conversions(t) if conversions else None,
        ad_conversions=ad_conversions(t) if conversions else None,
        keyword_conversions=keyword_conversions(t) if conversions else None,
    )
    if max_date is not None:
        facts = {k: (v.where(F.col("date") <= F.lit(max_date).cast("date")) if v is not None else None)
                 for k, v in facts.items()}
    return AdSources(
        accounts=account_history(t), campaigns=campaign_history(t), ad_groups=ad_group_history(t),
        ads=ad_history(t), keywords=keyword_history(t),
        calendar=calendar(t), currency=currency(t), **facts,
    )
