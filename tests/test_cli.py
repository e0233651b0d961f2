from pyspark.sql import functions as F

from adcube.__main__ import main
from adcube.sinks.table import read_table
from adcube.sources import testdata
from adcube.sources.catalog import SOURCE_TABLES

SF = "/root/testdata/sf0.001"


def test_cli_daily_run(spark, tmpdir_path, capsys):
    raw = f"{tmpdir_path}/raw"
    src = testdata.ad_sources(spark, SF)
    in_2000 = (F.col("date") >= F.lit("2000-01-01").cast("date")) & (F.col("date") <= F.lit("2000-01-31").cast("date"))
    for name, table in SOURCE_TABLES.items():
        df = getattr(src, name)
        if name.endswith("report") or name.endswith("conversions"):
            df = df.where(in_2000)  # one month of facts keeps the day-partitioned writes small
        df.write.parquet(f"{raw}/{table}")
    target = f"{tmpdir_path}/wh"
    args = ["--source-parquet", raw, "--target", target, "--entities", "campaign", "ad"]
    code = main(args)
    out = capsys.readouterr().out
    assert "staging_campaign: created" in out and "performance_by_ad: created" in out
    assert code == 1 and "test unique(staging_ad.unique_key): FAIL" in out  # ad goal fan-out, as in the reference
    before = read_table(spark, f"{target}/performance_by_campaign").count()
    main(args + ["--skip-tests"])
    out = capsys.readouterr().out
    assert "staging_campaign: upserted" in out and "performance_by_campaign: upserted" in out
    assert read_table(spark, f"{target}/performance_by_campaign").count() == before


def test_daily_run_into_catalog_tables_leaves_nothing_behind(spark, tmpdir_path):
    import os

    from adcube.session import ensure_checkpoint_dir
    root = f"{tmpdir_path}/raw"
    src = testdata.ad_sources(spark, SF)
    january = "date between date'2000-01-01' and date'2000-01-31'"
    src = src.with_(**{f"campaign_{k}": getattr(src, f"campaign_{k}").where(january) for k in ("report", "conversions")})
    for name, table in SOURCE_TABLES.items():
        getattr(src, name).write.parquet(f"{root}/{table}")
    spark.sql(f"CREATE DATABASE adcube_cli LOCATION '{tmpdir_path}/db'")
    shared = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(shared))
    args = ["--source-parquet", root, "--tables", "adcube_cli", "--entities", "campaign", "--skip-tests", "--currency", "EUR", "--as-of", "2001-01-01"]
    for _ in range(2):
        assert main(args) == 0
    assert spark.table("adcube_cli.staging_campaign").count() == src.campaign_report.select("date", "account_id", "campaign_id").distinct().count()
    assert spark.table("adcube_cli.performance_by_campaign").where("date_granularity = 'year'").count() > 0
    assert set(os.listdir(shared)) == before
    spark.sql("DROP DATABASE adcube_cli CASCADE")
