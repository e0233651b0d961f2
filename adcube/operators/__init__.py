"""DataFrame -> DataFrame operators of the engine."""

from .currency import convert_money, exchange_rates, is_money, unconverted_rows
from .enrich import dimension_chain, enrich, left_join
from .facts import aggregate_day, with_last_updated
from .goals import discover_goals, pivot_goals
from .latest import latest_versions
from .quality import assert_passes, not_null_violations, unique_violations
from .rollup import measure_columns, period_rollup, period_rollup_union, report_window_start

__all__ = [
    "convert_money", "exchange_rates", "is_money", "unconverted_rows", "dimension_chain",
    "enrich", "left_join", "aggregate_day", "with_last_updated", "discover_goals",
    "pivot_goals", "latest_versions", "assert_passes", "not_null_violations",
    "unique_violations", "measure_columns", "period_rollup", "period_rollup_union",
    "report_window_start",
]
