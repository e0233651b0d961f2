"""Command-line daily run: stage, report, (optionally) middle tables, then data tests.

    python -m adcube --source-parquet s3://raw/ads --target s3://warehouse/ads \
        [--currency EUR] [--entities campaign ad keyword] [--full-refresh] [--strict] [--middle] \\
        [--goals "Sign up" Purchase] [--exclude column ...] [--publish reporting]

``--tables reporting`` in the place of ``--target`` keeps the tables in the session catalog,
where a reader sees one whole run or the next (:mod:`adcube.sinks.snapshot`).

Each entity's staging table is upserted first and its report is then built
from the *written* staging table (so the report never re-joins raw rows).
The declared data tests run last and their failure counts are printed; the
exit code is 1 if any test fails.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import sys

from pyspark.sql import SparkSession

from .config import EngineConfig
from .plans.checks import DECLARED_TESTS, key_test_counts
from .plans.incremental import run_report, run_staging
from .plans.reports import middle, report_table_name
from .session import ensure_checkpoint_dir, intermediates
from .sinks import snapshot
from .sinks import table as path_tables
from .sources.catalog import AdSources
from .plans import dims


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="adcube", description=__doc__.splitlines()[0])
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--source-db", help="catalog database holding the raw tables")
    src.add_argument("--source-parquet", help="root folder with one Parquet dataset per raw table")
    to = p.add_mutually_exclusive_group(required=True)
    to.add_argument("--target", help="root folder for staging, report and middle tables")
    to.add_argument("--tables", help="catalog database for them instead; its readers see whole runs only")
    p.add_argument("--entities", nargs="+", default=["campaign", "ad", "keyword"],
                   choices=["campaign", "ad", "keyword"])
    p.add_argument("--currency", default="USD")
    p.add_argument("--week-start", default="Monday")
    p.add_argument("--conversion-measure", default="all_conversions")
    p.add_argument("--lookback-days", type=int, default=31)
    p.add_argument("--as-of", type=_dt.date.fromisoformat, default=None)
    p.add_argument("--namespace", default="")
    p.add_argument("--strict", action="store_true", help="reproduce the reference's known defects")
    p.add_argument("--goals", nargs="*", default=None, help="conversion goals; default: those found in the reports")
    p.add_argument("--exclude", nargs="*", default=[], help="further raw report columns to leave out")
    p.add_argument("--publish", default=None, help="catalog database that the written tables are registered in")
    p.add_argument("--full-refresh", action="store_true")
    p.add_argument("--middle", action="store_true", help="also rebuild the converted day-fact tables")
    p.add_argument("--skip-tests", action="store_true")
    return p.parse_args(argv)


def main(argv=None) -> int:
    a = parse_args(argv)
    spark = SparkSession.builder.appName("adcube").getOrCreate()
    ensure_checkpoint_dir(spark)  # small intermediate results go there
    cfg = EngineConfig(currency=a.currency, week_start=a.week_start, conversion_measure=a.conversion_measure,
                       lookback_days=a.lookback_days, as_of=a.as_of, namespace=a.namespace, strict=a.strict,
                       goals=None if a.goals is None else tuple(a.goals), extra_exclude=tuple(a.exclude))
    src = (AdSources.from_catalog(spark, a.source_db) if a.source_db
           else AdSources.from_parquet(spark, a.source_parquet))
    sink = snapshot if a.tables else path_tables

    def at(name: str) -> str:
        return f"{a.tables}.{name}" if a.tables else f"{a.target.rstrip('/')}/{name}"

    for entity in a.entities:
        stg, rep = at(f"staging_{entity}"), at(report_table_name(entity, cfg))
        print(f"staging_{entity}: {run_staging(spark, entity, src, cfg, stg, full_refresh=a.full_refresh, sink=sink)}")
        staging = sink.read_table(spark, stg)
        print(f"{report_table_name(entity, cfg)}: "
              f"{run_report(spark, entity, src, cfg, rep, staging=staging, full_refresh=a.full_refresh, sink=sink)}")
        if a.middle:
            with intermediates(spark):
                sink.write_table(middle(entity, src, cfg, staging=staging), at(f"middle_{entity}"), ("date",))
        if a.publish and not a.tables:
            path_tables.publish(spark, stg, f"{a.publish}.staging_{entity}")
            path_tables.publish(spark, rep, f"{a.publish}.{report_table_name(entity, cfg)}")
    if a.skip_tests:
        return 0
    built = {name: dims.dimension(getattr(src, name), name)
             for name in ("accounts", "campaigns", "ad_groups", "ads") if getattr(src, name) is not None}
    built.update({
        "staging_campaign": sink.read_table(spark, at("staging_campaign")),
        "staging_ad": sink.read_table(spark, at("staging_ad")),
        "performance_by_campaign": sink.read_table(spark, at(report_table_name("campaign", cfg))),
        "performance_by_ad": sink.read_table(spark, at(report_table_name("ad", cfg))),
    })
    failed = 0
    for model, tests in DECLARED_TESTS:
        if built.get(model) is None:
            continue
        counts = key_test_counts(built[model]).first()
        for t in tests:
            n = counts[t]
            failed += n > 0
            print(f"test {t}({model}.unique_key): {'PASS' if n == 0 else f'FAIL {n} rows'}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
