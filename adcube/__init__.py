"""adcube: Spark-native ad-performance reporting.

Reads entity history tables and daily performance / conversion reports as
DataFrames and builds latest-version dimensions, day-grain staging facts with
pivoted conversion goals, currency-converted facts and multi-granularity
(day/week/month/quarter/year) reports, with keyed incremental upserts and
data-quality checks.
"""

from .config import EngineConfig, GRANULARITIES

__all__ = ["EngineConfig", "GRANULARITIES"]
