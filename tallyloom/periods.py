"""Month arithmetic and column names, worked out on the driver.

A period is the integer ``YEAR * 100 + MONTH``. Nothing here touches data: a
report needs at most two dozen of these integers, and they become literals in
its plan.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month abbreviations, so that column names do not follow
# the locale of the driver.
MONTH_NAMES = (
    "Jan", "Feb", "Mar", "Apr", "May", "Jun",
    "Jul", "Aug", "Sep", "Oct", "Nov", "Dec",
)


def period_of(day: date) -> int:
    return day.year * 100 + day.month


def months_before(as_of: date, steps: int) -> int:
    """The period `steps` months before the month of `as_of`."""
    year, month = divmod(as_of.year * 12 + as_of.month - 1 - steps, 12)
    return year * 100 + month + 1


def next_period(period: int) -> int:
    year, month = divmod(period, 100)
    return (year + 1) * 100 + 1 if month == 12 else period + 1


def trailing_months(as_of: date, count: int = 12) -> list[int]:
    """The last `count` complete months, newest first."""
    return [months_before(as_of, step) for step in range(1, count + 1)]


def prior_years(as_of: date, count: int = 3) -> list[int]:
    """The last `count` complete calendar years, newest first."""
    return [as_of.year - step for step in range(1, count + 1)]


def year_span(year: int) -> tuple[int, int]:
    """First and last period of a calendar year."""
    return year * 100 + 1, year * 100 + 12


def ytd_span(as_of: date) -> tuple[int, int]:
    """First and last period of the year to date; empty (last < first) in January."""
    return as_of.year * 100 + 1, as_of.year * 100 + as_of.month - 1


def month_label(period: int, style: str) -> str:
    """Fill `{mon}`, `{yy}` and `{yyyy}` in `style` for a period."""
    year, month = divmod(period, 100)
    return style.format(mon=MONTH_NAMES[month - 1], yy=f"{year % 100:02d}", yyyy=year)


def period_key() -> Column:
    """``YEARMONTH`` of a row that has integer ``YEAR`` and ``MONTH`` columns."""
    return F.col("YEAR") * F.lit(100) + F.col("MONTH")
