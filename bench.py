"""Benchmark: wall seconds per headline query; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query after one warm-up, default 2; median kept).
Each query is fully evaluated with the ``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from adcube.config import EngineConfig  # noqa: E402
from adcube.operators.rollup import measure_columns, period_rollup, period_rollup_union  # noqa: E402
from adcube.plans.reports import REPORTS, converted_facts  # noqa: E402
from adcube.plans.staging import staging_ad  # noqa: E402
from adcube.queries import QUERIES  # noqa: E402
from adcube.session import local_session  # noqa: E402
from adcube.sources import testdata  # noqa: E402

HEADLINE = [
    "report_by_campaign", "report_by_ad", "report_by_keyword", "report_by_campaign_eur",
    "staging_campaign", "staging_ad", "staging_keyword", "middle_keyword_eur",
    "dim_ads", "goal_pivot_ad", "report_incremental_exact", "upsert_entity_keys",
]


def _rollup_variant(fn):
    """Ad report roll-up only (no dims), one-pass vs union, over the same facts."""
    def q(spark, sf_dir):
        src = testdata.ad_sources(spark, sf_dir)
        facts = converted_facts(staging_ad(src, EngineConfig(), ), "ad", src, EngineConfig())
        measures = measure_columns(facts, facts.columns, REPORTS["ad"].measure_exclude, ["ad_id"])
        return fn(facts, ["ad_id"], measures)
    return q


def _ad_report_via_staging(spark, sf_dir):
    """The ad report over the row-level staging join (what a materialized staging feeds)."""
    from adcube.plans.reports import report
    src = testdata.ad_sources(spark, sf_dir)
    cfg = EngineConfig()
    return report("ad", src, cfg, staging=staging_ad(src, cfg))


ALTERNATIVES = {
    "alt_rollup_one_pass": _rollup_variant(period_rollup),
    "alt_rollup_union": _rollup_variant(period_rollup_union),
    "alt_report_ad_row_level_goal_join": _ad_report_via_staging,
}


def timed(spark, fn, sf_dir, runs):
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * int(cpus)), app="adcube-bench")
    for name in HEADLINE[:3]:  # JVM / code-generation warm-up, untimed
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    results = {}
    for name in HEADLINE:
        results[name] = round(timed(spark, QUERIES[name], sf_dir, runs), 3)
    for name, fn in ALTERNATIVES.items():
        results[name] = round(timed(spark, fn, sf_dir, runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    total = round(sum(results[n] for n in HEADLINE), 3)
    print(json.dumps({"metric": "headline_queries_total_wall", "value": total, "unit": "sec",
                      "queries": results, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": int(cpus), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
