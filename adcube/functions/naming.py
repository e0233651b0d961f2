"""Column naming rules: raw connector names -> report names, goal -> column.

Both are plain Python over names (they run once per column on the driver and
produce ``Column`` expressions); no Spark job and no UDF is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Timestamp columns renamed to ``updated_at``.
MODIFIED_TIME_COLUMNS = ("last_modified_time", "modified_time")

# Percent columns scaled to a fraction, with their output names.
PERCENT_COLUMNS = {
    "impression_share_percent": "impression_share",
    "impression_lost_to_budget_percent": "impression_lost_to_budget_percent",
    "impression_lost_to_rank_agg_percent": "impression_lost_to_rank_agg_percent",
}

# Characters deleted from a lower-cased goal name.
GOAL_NAME_DELETED_CHARS = "().&- !:/+|<>"


def clean_field_name(table: str, column: str) -> str:
    """Output name of ``column`` read from source ``table`` (first rule wins)."""
    if column in MODIFIED_TIME_COLUMNS:
        return "updated_at"
    if column in PERCENT_COLUMNS:
        return PERCENT_COLUMNS[column]
    if "keyword" in column and column != "keyword_id":
        # text between the first and second occurrence of "keyword"
        return "keyword_" + column.split("keyword")[1]
    if "account" in table:
        return f"account_{column}"
    for marker, prefix in (("campaigns", "campaign_"), ("ad_groups", "ad_group_"), ("ads", "ad_")):
        if marker in table:
            return column if "_id" in column else prefix + column
    if "keyword" in table:
        return "keyword_id" if column == "id" else column
    return column


def clean_field(table: str, column: str) -> Column:
    """``Column`` for ``column`` of ``table`` renamed (and scaled) by the rules."""
    name = clean_field_name(table, column)
    if column in PERCENT_COLUMNS:
        return (F.col(column).cast("double") / F.lit(100.0)).alias(name)
    return F.col(column).alias(name)


def clean_columns(table: str, columns, exclude=()) -> list[Column]:
    """Project-by-exclusion followed by renaming, in source column order."""
    dropped = set(exclude)
    return [clean_field(table, c) for c in columns if c not in dropped]


def clean_goal_name(goal: str) -> str:
    """Goal value -> column name: lower-case, then delete the fixed characters."""
    return goal.lower().translate({ord(ch): None for ch in GOAL_NAME_DELETED_CHARS})


def clean_goal_name_col(goal: Column) -> Column:
    """Column form of :func:`clean_goal_name` (same result, runs JVM-side)."""
    return F.translate(F.lower(goal), GOAL_NAME_DELETED_CHARS, "")


def goal_columns(goals, existing=()) -> list[tuple[str, str, str]]:
    """``[(goal, count_column, value_column)]``; raises on any name collision.

    Two goals that clean to the same name, or a goal column that equals an
    existing column, would give duplicate columns (Spark compares names
    case-insensitively), so they are rejected up front.
    """
    out: list[tuple[str, str, str]] = []
    seen: dict[str, str] = {c.lower(): f"existing column {c!r}" for c in existing}
    for goal in goals:
        name = clean_goal_name(goal)
        if not name:
            raise ValueError(f"goal {goal!r} cleans to an empty column name")
        for col in (name, f"{name}_value"):
            key = col.lower()
            if key in seen:
                raise ValueError(
                    f"goal {goal!r} gives column {col!r}, which collides with {seen[key]}"
                )
            seen[key] = f"goal {goal!r}"
        out.append((goal, name, f"{name}_value"))
    return out
