"""Column-level functions (pure ``Column`` builders, JVM-side, no UDFs)."""

from .classify import campaign_type
from .dates import date_part_columns, period_start, week_start_of, weekday_number
from .keys import share_denominator, share_numerator, surrogate_key, weighted_share
from .naming import (
    clean_columns,
    clean_field,
    clean_field_name,
    clean_goal_name,
    clean_goal_name_col,
    goal_columns,
)

__all__ = [
    "campaign_type", "date_part_columns", "period_start", "week_start_of", "weekday_number",
    "share_denominator", "share_numerator", "surrogate_key", "weighted_share",
    "clean_columns", "clean_field", "clean_field_name", "clean_goal_name",
    "clean_goal_name_col", "goal_columns",
]
