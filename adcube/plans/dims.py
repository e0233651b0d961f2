"""Latest-version dimensions and the hierarchies joined onto reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.naming import clean_columns, clean_field_name
from ..operators.enrich import dimension_chain
from ..operators.latest import latest_versions
from ..session import written
from ..sources.catalog import AdSources
from .columns import DIM_FIELDS, DIM_TIME, REPORT_DIM_COLUMNS


def dimension(history: DataFrame, entity: str) -> DataFrame:
    """Latest version of each ``entity`` row, renamed, with ``unique_key = <entity>_id``."""
    fields, ts = DIM_FIELDS[entity], DIM_TIME[entity]
    latest = latest_versions(history.select(*fields), "id", ts)
    out = latest.select(*clean_columns(entity, fields, exclude=(ts,)))
    return out.withColumn("unique_key", F.col(clean_field_name(entity, "id")))


def dim_accounts(src: AdSources) -> DataFrame:
    return dimension(src.require("accounts"), "accounts")


def dim_campaigns(src: AdSources) -> DataFrame:
    return dimension(src.require("campaigns"), "campaigns")


def dim_ad_groups(src: AdSources) -> DataFrame:
    return dimension(src.require("ad_groups"), "ad_groups")


def dim_ads(src: AdSources) -> DataFrame:
    return dimension(src.require("ads"), "ads")


def dim_keywords(src: AdSources) -> DataFrame:
    return dimension(src.require("keywords"), "keywords")


def _report_dim(src: AdSources, entity: str, ids: DataFrame | None = None) -> DataFrame:
    history = src.require(entity)
    if ids is not None:
        history = history.join(ids, "id", "left_semi")  # before the newest versions are looked for
    return dimension(history, entity).select(*REPORT_DIM_COLUMNS[entity])


# entity of a report -> dimension levels walked outward, with the join key of each
HIERARCHIES = {
    "campaign": (("campaigns", None), ("accounts", "account_id")),
    "ad": (("ads", None), ("ad_groups", "ad_group_id"), ("campaigns", "campaign_id"),
           ("accounts", "account_id")),
    "keyword": (("keywords", None), ("ad_groups", "ad_group_id"), ("campaigns", "campaign_id"),
                ("accounts", "account_id")),
}


def _ids(column: DataFrame) -> DataFrame:
    return column.toDF("id").where(F.col("id").isNotNull()).distinct()


def hierarchy(src: AdSources, entity: str, cfg: EngineConfig, ids: DataFrame | None = None) -> DataFrame:
    """Report-side dimension columns of ``entity`` with all its ancestors, one frame.

    ``ids`` (one column: the entities of a batch) keeps every level to what the batch needs: the
    versions of other ids are left out *below* the search for the newest version, so they are not
    shuffled.  The ids of the next level up come from the versions found, which are written:
    the planner then knows how many there are and broadcasts them, or builds a Bloom filter of
    them for the scan (``tune_for_scale`` sets its bounds), or sorts both sides.
    """
    if ids is None:
        return dimension_chain([(_report_dim(src, name), key) for name, key in HIERARCHIES[entity]])
    levels, wanted = [], written(_ids(ids))
    for name, key in HIERARCHIES[entity]:
        if key is not None:
            wanted = _ids(levels[-1][0].select(key))
        found = _report_dim(src, name, wanted)
        levels.append((found if name == "accounts" else written(found), key))
    return dimension_chain(levels)
