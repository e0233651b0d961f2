"""Model plans: dimensions, staging facts, converted facts, reports, incremental runs."""

from .dims import dim_accounts, dim_ad_groups, dim_ads, dim_campaigns, dim_keywords, dimension, hierarchy
from .reports import middle, report, report_by_ad, report_by_campaign, report_by_keyword
from .staging import staging_ad, staging_campaign, staging_keyword

__all__ = [
    "dim_accounts", "dim_ad_groups", "dim_ads", "dim_campaigns", "dim_keywords", "dimension",
    "hierarchy", "middle", "report", "report_by_ad", "report_by_campaign", "report_by_keyword",
    "staging_ad", "staging_campaign", "staging_keyword",
]
