"""Exchange rates with a one-day lag and money-column conversion."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Money columns converted to the reporting currency (besides any
# column whose name contains "_value").
MONEY_COLUMNS = ("spend", "revenue", "all_revenue")


def is_money(column: str) -> bool:
    return column in MONEY_COLUMNS or "_value" in column


def exchange_rates(calendar: DataFrame, currency: DataFrame, code: str,
                   as_of: _dt.date | None = None) -> DataFrame:
    """``(date, raw_rate, exchange_rate)``: rate = last non-NULL rate strictly before the day.

    The calendar is cut at ``as_of`` (today by default) *before* the lag.  The
    window has no partition: it runs over the calendar (one row per day, tens
    of thousands at most), never over facts.
    """
    bound: Column = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    cal = calendar.select(F.col("date").cast("date").alias("date")).where(F.col("date") <= bound)
    rates = currency.select(F.col("date").cast("date").alias("date"),
                            F.col(code).cast("double").alias("raw_rate"))
    days = cal.join(rates, "date", "left")
    prev = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    return days.select("date", "raw_rate",
                       F.last("raw_rate", ignorenulls=True).over(prev).alias("exchange_rate")).distinct()


def convert_money(df: DataFrame, rates: DataFrame | None) -> DataFrame:
    """Money columns as double divided by the day's rate; ``rates=None`` means USD (÷1).

    A day without a rate gives NULL money (reports turn it into 0).
    """
    money = [c for c in df.columns if is_money(c)]
    if rates is None:
        return df.withColumns({c: F.col(c).cast("double") for c in money})
    r = rates.select(F.col("date").alias("_rate_date"), "exchange_rate")
    j = df.join(r, df["date"] == r["_rate_date"], "left")
    return (j.withColumns({c: F.col(c).cast("double") / F.col("exchange_rate") for c in money})
            .drop("_rate_date", "exchange_rate"))


def unconverted_rows(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Rows of ``df`` whose day has no usable rate (their money converts to NULL).

    Dates after ``as_of``, the first calendar day and days before the first
    rate fall here; reports then show 0 for their money.  A left-anti join
    against the calendar-sized days that do have a rate.
    """
    known = rates.where(F.col("exchange_rate").isNotNull()).select("date")
    return df.join(known, "date", "left_anti")
