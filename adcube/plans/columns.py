"""Column lists of the ad model.

Fixed values: these names must equal the reference's so that the same raw
columns are dropped, kept and summed.  They are stated here once, in the
reference's order.
"""

# --- dimension fields read from each history table (time column included) ---
DIM_FIELDS = {
    "accounts": ("id", "name", "currency_code", "last_modified_time"),
    "campaigns": ("id", "name", "budget", "status", "modified_time", "account_id", "type"),
    "ad_groups": ("id", "name", "status", "modified_time", "campaign_id"),
    "ads": ("id", "text", "type", "status", "modified_time", "ad_group_id"),
    "keywords": ("id", "name", "match_type", "status", "modified_time", "ad_group_id"),
}
DIM_TIME = {
    "accounts": "last_modified_time",
    "campaigns": "modified_time",
    "ad_groups": "modified_time",
    "ads": "modified_time",
    "keywords": "modified_time",
}

# --- raw performance-report columns dropped before staging ---
CAMPAIGN_RAW_EXCLUDE = (
    "_fivetran_id", "ctr", "expected_ctr", "historical_expected_ctr", "historical_ad_relevance",
    "historical_landing_page_experience", "ptr", "average_cpc", "conversion_rate",
    "cost_per_conversion", "low_quality_clicks_percent", "low_quality_impressions_percent",
    "low_quality_conversion_rate", "return_on_ad_spend", "cost_per_assist",
    "revenue_per_conversion", "revenue_per_assist", "all_conversion_rate",
    "all_cost_per_conversion", "all_revenue_on_ad_spend", "all_revenue_per_conversion",
    "custom_parameters", "absolute_top_impression_share_lost_to_rank_percent",
    "absolute_top_impression_share_percent", "absolute_top_impression_share_lost_to_budget_percent",
    "absolute_top_impression_rate_percent", "exact_match_impression_share_percent",
    "top_impression_share_lost_to_rank_percent", "top_impression_share_percent",
    "top_impression_share_lost_to_budget_percent", "top_impression_rate_percent",
    "impression_lost_to_rank_agg_percent", "impression_lost_to_budget_percent",
)
AD_RAW_EXCLUDE = (
    "ctr", "average_cpc", "conversion_rate", "cost_per_conversion", "return_on_ad_spend",
    "cost_per_assist", "revenue_per_conversion", "revenue_per_assist", "all_conversion_rate",
    "all_cost_per_conversion", "all_revenue_on_ad_spend", "all_revenue_per_conversion",
)
KEYWORD_RAW_EXCLUDE = AD_RAW_EXCLUDE

# --- conversion-report columns read by the goal pivot (keys + these) ---
CONVERSION_FIELDS = ("goal", "conversions", "all_conversions", "revenue", "all_revenue")

# --- staging columns dropped by the currency-converted facts and reports ---
CAMPAIGN_FACT_EXCLUDE = (
    "unique_key", "_fivetran_synced", "ad_distribution", "account_id", "campaign_name",
    "campaign_status", "currency_code", "delivered_match_type", "device_type", "network",
    "average_position", "conversions_qualified", "low_quality_clicks", "low_quality_impressions",
    "low_quality_conversions", "low_quality_general_clicks", "low_quality_sophisticated_clicks",
    "quality_socre", "ad_relevance", "landing_page_experience", "phone_impressions", "phone_calls",
    "all_conversions_qualified",
)
AD_FACT_EXCLUDE = (
    "unique_key", "_fivetran_synced", "ad_distribution", "account_id", "campaign_id",
    "ad_group_id", "bid_match_type", "delivered_match_type", "currency_code", "device_os",
    "device_type", "language", "network", "ad_description", "ad_description_2", "top_vs_other",
    "average_position", "conversions_qualified", "all_conversions_qualified",
)
KEYWORD_FACT_EXCLUDE = (
    "unique_key", "_fivetran_synced", "ad_distribution", "account_id", "campaign_id",
    "ad_group_id", "bid_match_type", "delivered_match_type", "keyword_status", "currency_code",
    "device_os", "device_type", "language", "network", "top_vs_other", "average_position",
    "conversions_qualified", "all_conversions_qualified", "current_max_cpc", "quality_score",
    "expected_ctr", "ad_relevance", "landing_page_experience", "historical_quality_score",
    "historical_expected_ctr", "historical_ad_relevance", "historical_landing_page_experience",
    "quality_impact", "keyword__status", "all_return_on_ad_spend",
)

# --- report columns that are never summed ---
DATE_PART_COLUMNS = ("day", "week", "month", "quarter", "year")
CAMPAIGN_MEASURE_EXCLUDE = ("date", *DATE_PART_COLUMNS, "last_updated", "unique_key")
AD_MEASURE_EXCLUDE = (*CAMPAIGN_MEASURE_EXCLUDE, "destination_url")
KEYWORD_MEASURE_EXCLUDE = AD_MEASURE_EXCLUDE

# --- dimension columns joined onto each report ---
REPORT_DIM_COLUMNS = {
    "keywords": ("keyword_id", "ad_group_id", "name", "match_type", "status"),
    "ads": ("ad_id", "ad_text", "ad_type", "ad_status", "ad_group_id"),
    "ad_groups": ("ad_group_id", "ad_group_name", "ad_group_status", "campaign_id"),
    "campaigns": ("campaign_id", "campaign_name", "campaign_budget", "campaign_status",
                  "account_id", "campaign_type"),
    "accounts": ("account_id", "account_name", "account_currency_code"),
}
