"""Source catalogs: the raw tables of the ad model as DataFrames."""

from .catalog import SOURCE_TABLES, AdSources

__all__ = ["SOURCE_TABLES", "AdSources"]
