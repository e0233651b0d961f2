from adcube.config import EngineConfig
from adcube.sinks.table import read_table
from adcube.sources import testdata
from adcube.streaming import start_staging_stream

SF = "/root/testdata/sf0.001"


def test_stream_triggers_incremental_upsert(spark, tmpdir_path):
    cfg = EngineConfig(strict=False)
    landing = f"{tmpdir_path}/landing"
    target = f"{tmpdir_path}/staging"
    full = testdata.ad_sources(spark, SF)
    report = full.campaign_report
    report.where("date <= DATE'1997-12-31'").write.parquet(f"{landing}/part1")
    q = start_staging_stream(spark, "campaign", f"{landing}/*", report.schema,
                             lambda s: testdata.ad_sources(s, SF), cfg, target, f"{tmpdir_path}/ckpt",
                             partition_by=())
    q.awaitTermination(300)
    from adcube.plans.staging import staging_campaign
    first = read_table(spark, target).count()
    report.where("date > DATE'1997-12-31'").write.parquet(f"{landing}/part2")
    q = start_staging_stream(spark, "campaign", f"{landing}/*", report.schema,
                             lambda s: testdata.ad_sources(s, SF), cfg, target, f"{tmpdir_path}/ckpt",
                             partition_by=())
    q.awaitTermination(300)
    assert first == staging_campaign(full, cfg).count()  # days older than the first batch are there too
    assert read_table(spark, target).count() == staging_campaign(full, cfg).count()
