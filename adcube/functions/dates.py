"""Calendar helpers: period starts for the five report granularities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import GRANULARITIES

# Day names (full and three-letter), numbered as Spark's
# ``dayofweek`` numbers them (1 = Sunday ... 7 = Saturday).
WEEKDAY_NUMBERS = {
    "sunday": 1, "sun": 1,
    "monday": 2, "mon": 2,
    "tuesday": 3, "tue": 3,
    "wednesday": 4, "wed": 4,
    "thursday": 5, "thu": 5,
    "friday": 6, "fri": 6,
    "saturday": 7, "sat": 7,
}


def weekday_number(week_start: str) -> int:
    try:
        return WEEKDAY_NUMBERS[week_start.strip().lower()]
    except KeyError:
        raise ValueError(f"unknown week_start {week_start!r}") from None


def week_start_of(date: Column, week_start: str = "Monday") -> Column:
    """First day of the week holding ``date`` for weeks starting on ``week_start``."""
    s = weekday_number(week_start)
    if s == 2:
        return F.trunc(date, "week")  # Monday weeks: built-in, codegen'd
    return F.date_sub(date, F.pmod(F.dayofweek(date) - F.lit(s), F.lit(7)))


def period_start(date: Column, granularity: str, week_start: str = "Monday") -> Column:
    """Start date of the ``granularity`` period holding ``date``.

    ``day`` is the date itself (``trunc(d, 'DAY')`` is NULL in Spark).
    """
    if granularity == "day":
        return date
    if granularity == "week":
        return week_start_of(date, week_start)
    if granularity in ("month", "quarter", "year"):
        return F.trunc(date, granularity)
    raise ValueError(f"unknown granularity {granularity!r}")


def date_part_columns(date_col: str = "date", week_start: str = "Monday") -> dict[str, Column]:
    """``{day, week, month, quarter, year}`` period-start columns for ``withColumns``."""
    d = F.col(date_col)
    return {g: period_start(d, g, week_start) for g in GRANULARITIES}


def week_start_date(day, week_start: str = "Monday"):
    """Python twin of :func:`week_start_of` for driver-side bounds (``datetime.date``)."""
    import datetime as _dt
    s = weekday_number(week_start)
    dow = day.isoweekday() % 7 + 1  # Spark numbering: 1 = Sunday
    return day - _dt.timedelta(days=(dow - s) % 7)
