"""Source tables of the ad model, bundled as lazy DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Logical source name -> physical table name of the raw
# connector schema.
SOURCE_TABLES = {
    "accounts": "account_history",
    "campaigns": "campaign_history",
    "ad_groups": "ad_group_history",
    "ads": "ad_history",
    "keywords": "keyword_history",
    "ad_report": "ad_performance_daily_report",
    "campaign_report": "campaign_impression_performance_daily_report",
    "keyword_report": "keyword_performance_daily_report",
    "campaign_conversions": "campaign_conversion_performance_daily_report",
    "ad_conversions": "ad_conversion_performance_daily_report",
    "keyword_conversions": "conversion_performance_daily_report",
    "calendar": "dates",
    "currency": "currency",
}


@dataclass(frozen=True)
class AdSources:
    """Raw inputs. Conversion reports, calendar and currency are optional.

    A missing conversion report means "no goal columns"; calendar and currency
    are only read when the reporting currency is not USD.
    """

    accounts: DataFrame | None = None
    campaigns: DataFrame | None = None
    ad_groups: DataFrame | None = None
    ads: DataFrame | None = None
    keywords: DataFrame | None = None
    ad_report: DataFrame | None = None
    campaign_report: DataFrame | None = None
    keyword_report: DataFrame | None = None
    campaign_conversions: DataFrame | None = None
    ad_conversions: DataFrame | None = None
    keyword_conversions: DataFrame | None = None
    calendar: DataFrame | None = None
    currency: DataFrame | None = None

    def with_(self, **kw) -> "AdSources":
        return replace(self, **kw)

    def require(self, name: str) -> DataFrame:
        df = getattr(self, name)
        if df is None:
            raise ValueError(f"source {name!r} ({SOURCE_TABLES[name]}) is required here")
        return df

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> "AdSources":
        """Read every source that exists in ``database`` of the session catalog."""
        kw = {}
        for f in fields(cls):
            ident = f"{database}.{SOURCE_TABLES[f.name]}"
            kw[f.name] = spark.read.table(ident) if spark.catalog.tableExists(ident) else None
        return cls(**kw)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> "AdSources":
        """Read ``<root>/<table>`` Parquet datasets; absent paths become ``None``.

        Works on any Hadoop file system.  Only a path that does not exist is an
        absent table; one that cannot be read is an error.
        """
        kw = {}
        for f in fields(cls):
            path = f"{root.rstrip('/')}/{SOURCE_TABLES[f.name]}"
            try:
                kw[f.name] = spark.read.parquet(path)
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                kw[f.name] = None
        return cls(**kw)
