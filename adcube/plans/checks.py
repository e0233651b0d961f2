"""The reference's declared data tests, run as one distributed summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..config import EngineConfig
from ..sources.catalog import AdSources
from . import dims
from .reports import REPORTS, report
from .staging import staging_ad, staging_campaign

# Fixed values: (model, tests on its unique_key) as declared by the reference.
DECLARED_TESTS = (
    ("accounts", ("unique", "not_null")),
    ("campaigns", ("unique", "not_null")),
    ("staging_campaign", ("unique", "not_null")),
    ("performance_by_campaign", ("unique",)),
    ("ad_groups", ("unique", "not_null")),
    ("ads", ("unique", "not_null")),
    ("staging_ad", ("unique", "not_null")),
    ("performance_by_ad", ("unique",)),
)


def declared_models(src: AdSources, cfg: EngineConfig) -> dict[str, DataFrame]:
    return {
        "accounts": dims.dim_accounts(src),
        "campaigns": dims.dim_campaigns(src),
        "staging_campaign": staging_campaign(src, cfg),
        "performance_by_campaign": report("campaign", src, cfg),
        "ad_groups": dims.dim_ad_groups(src),
        "ads": dims.dim_ads(src),
        "staging_ad": staging_ad(src, cfg),
        "performance_by_ad": report("ad", src, cfg),
    }


def key_test_counts(df: DataFrame, column: str = "unique_key", within: str | None = None) -> DataFrame:
    """One row: ``unique`` failures (rows sharing a repeated non-NULL value) and
    ``not_null`` failures, from a single aggregation over ``column``.

    ``within``: rows that share a value share this column too, unless it is NULL, when the
    value is NULL as well.  Rows that lie by it are then counted in place.
    """
    count = F.count(F.lit(1)).alias("n")
    if within is None:
        per_key = df.groupBy(column).agg(count)
    else:
        known = df.where(F.col(within).isNotNull()).groupBy(within, column).agg(count).drop(within)
        per_key = known.unionByName(df.where(F.col(within).isNull()).groupBy(column).agg(count))
    key = F.col(column)
    return per_key.agg(
        F.coalesce(F.sum(F.when(key.isNotNull() & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias("unique"),
        F.coalesce(F.sum(F.when(key.isNull(), F.col("n"))), F.lit(0)).alias("not_null"))


def _within(model: str, df: DataFrame) -> str | None:
    """The entity that an ad report's key names; keys of text ids could name two."""
    spec = REPORTS["ad"]
    ids = [c for c in spec.key if c.endswith("_id")]
    whole = model == "performance_by_ad" and all(c in df.columns and isinstance(df.schema[c].dataType, IntegralType) for c in ids)
    return spec.dimension if whole else None


def declared_tests(src: AdSources, cfg: EngineConfig, models: dict[str, DataFrame] | None = None) -> DataFrame:
    """``(model, column_name, test, failures)`` for every declared test; one job when collected.

    Same results as :func:`~adcube.operators.quality.unique_violations` /
    ``not_null_violations``, but each model is aggregated once for both tests.
    """
    models = models or declared_models(src, cfg)
    parts = []
    for m, tests in DECLARED_TESTS:
        counts = key_test_counts(models[m], within=_within(m, models[m]))
        tagged = F.array(*[F.struct(F.lit(t).alias("test"), F.col(t).cast("long").alias("failures"))
                           for t in tests])
        parts.append(counts.select(F.lit(m).alias("model"), F.lit("unique_key").alias("column_name"),
                                   F.inline(tagged)))
    return reduce(DataFrame.unionByName, parts)
