import pytest

from adcube.functions.naming import clean_field_name, clean_goal_name, goal_columns


@pytest.mark.parametrize("table,column,expected", [
    ("accounts", "id", "account_id"),
    ("accounts", "name", "account_name"),
    ("accounts", "currency_code", "account_currency_code"),
    ("campaigns", "id", "campaign_id"),
    ("campaigns", "account_id", "account_id"),
    ("campaigns", "type", "campaign_type"),
    ("ad_groups", "campaign_id", "campaign_id"),
    ("ad_groups", "status", "ad_group_status"),
    ("ads", "text", "ad_text"),
    ("ads", "ad_group_id", "ad_group_id"),
    ("keywords", "name", "name"),
    ("keywords", "id", "keyword_id"),
    ("keyword_performance_daily_report", "keyword_status", "keyword__status"),
    ("keyword_performance_daily_report", "keyword", "keyword_"),
    ("keyword_performance_daily_report", "keyword_id", "keyword_id"),
    ("campaign_impression_performance_daily_report", "impression_share_percent", "impression_share"),
    ("ad_performance_daily_report", "impression_lost_to_budget_percent", "impression_lost_to_budget_percent"),
    ("campaigns", "modified_time", "updated_at"),
    ("accounts", "last_modified_time", "updated_at"),
    ("ad_performance_daily_report", "spend", "spend"),
])
def test_clean_field(table, column, expected):
    assert clean_field_name(table, column) == expected


def test_goal_name():
    assert clean_goal_name("Sign Up (A/B) - x+y|<z>!:.&") == "signupabxyz"
    assert clean_goal_name("4-NOT SPECIFIED") == "4notspecified"


def test_goal_collisions_raise():
    with pytest.raises(ValueError):
        goal_columns(["Sign Up", "signup"])
    with pytest.raises(ValueError):
        goal_columns(["Conversions"], existing=["conversions"])
    assert goal_columns(["Buy (A/B)"]) == [("Buy (A/B)", "buyab", "buyab_value")]
