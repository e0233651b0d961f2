"""Run-time parameters of the engine (the reference's project variables)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace

# Fixed values (must equal the reference's defaults): reporting currency,
# first day of the week, the measure used for custom conversions, and the
# incremental reprocessing window in days.
DEFAULT_CURRENCY = "USD"
DEFAULT_WEEK_START = "Monday"
DEFAULT_CONVERSION_MEASURE = "all_conversions"
DEFAULT_LOOKBACK_DAYS = 31

# Which value column pairs with each custom-conversion measure.
CONVERSION_VALUE_COLUMN = {
    "conversions": "revenue",
    "all_conversions": "all_revenue",
}

# The five report granularities, in report order.
GRANULARITIES = ("day", "week", "month", "quarter", "year")


@dataclass(frozen=True)
class EngineConfig:
    """Parameters shared by every plan.

    ``as_of`` replaces ``current_date`` in the exchange-rate calendar so runs are
    reproducible; ``None`` means today.  By default runs are exact: an
    incremental run gives what a full refresh gives.  ``strict`` selects
    bit-for-bit reference behaviour where the reference has a known defect (see
    README "Semantics").  ``max_goals`` (``None``: no bound) makes goal discovery
    fail above so many goals.  ``extra_exclude`` names further raw report columns
    that no table carries.
    """

    currency: str = DEFAULT_CURRENCY
    week_start: str = DEFAULT_WEEK_START
    conversion_measure: str = DEFAULT_CONVERSION_MEASURE
    lookback_days: int = DEFAULT_LOOKBACK_DAYS
    as_of: _dt.date | None = None
    namespace: str = ""
    strict: bool = False
    max_goals: int | None = None
    extra_exclude: tuple[str, ...] = ()
    goals: tuple[str, ...] | None = field(default=None)

    def __post_init__(self) -> None:
        if self.conversion_measure not in CONVERSION_VALUE_COLUMN:
            raise ValueError(
                f"conversion_measure must be one of {sorted(CONVERSION_VALUE_COLUMN)},"
                f" got {self.conversion_measure!r}"
            )
        if self.lookback_days < 0:
            raise ValueError("lookback_days must be >= 0")
        from .functions.dates import weekday_number
        weekday_number(self.week_start)  # raises on an unknown day name

    @property
    def conversion_value(self) -> str:
        return CONVERSION_VALUE_COLUMN[self.conversion_measure]

    @property
    def converts_currency(self) -> bool:
        return self.currency != "USD"

    def with_(self, **kw) -> "EngineConfig":
        return replace(self, **kw)
