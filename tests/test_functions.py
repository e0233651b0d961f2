import datetime as dt

from pyspark.sql import functions as F

from adcube.functions.classify import campaign_type
from adcube.functions.dates import period_start, week_start_date
from adcube.functions.keys import surrogate_key


def test_campaign_type(spark):
    names = ["Brand Search", "SEARCH NonBrand", "Search Generic", "Shopping - Brand", "shopping unbranded",
             "Shopping", "Search Non-Brand", "Display Brand", None]
    expected = ["Campaign Type: Search Branded", "Campaign Type: Search Nonbrand", "Campaign Type: Search",
                "Campaign Type: Shopping Branded", "Campaign Type: Shopping Nonbrand", "Campaign Type: Shopping",
                "Campaign Type: Search Branded", "", ""]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r[0] for r in df.select(campaign_type(F.col("name"))).collect()]
    assert got == expected


def test_period_starts(spark):
    days = [dt.date(2024, 12, 31), dt.date(2025, 1, 1), dt.date(2025, 1, 6), dt.date(2025, 1, 5)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    cols = [period_start(F.col("date"), g).alias(g) for g in ("day", "week", "month", "quarter", "year")]
    cols.append(period_start(F.col("date"), "week", "Sunday").alias("week_sun"))
    rows = df.select(*cols).collect()
    assert rows[0]["week"] == dt.date(2024, 12, 30) and rows[1]["week"] == dt.date(2024, 12, 30)
    assert rows[2]["week"] == dt.date(2025, 1, 6)
    assert rows[0]["quarter"] == dt.date(2024, 10, 1) and rows[1]["year"] == dt.date(2025, 1, 1)
    assert rows[0]["day"] == days[0]
    assert rows[3]["week_sun"] == dt.date(2025, 1, 5) and rows[2]["week_sun"] == dt.date(2025, 1, 5)
    for d, r in zip(days, rows):
        assert week_start_date(d, "Monday") == r["week"]
        assert week_start_date(d, "Sunday") == r["week_sun"]


def test_surrogate_key_null_propagates(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 2)), (None, dt.date(2024, 1, 2))], "a long, d date")
    got = [r[0] for r in df.select(surrogate_key("a", "d")).collect()]
    assert got == ["1_2024-01-02", None]
