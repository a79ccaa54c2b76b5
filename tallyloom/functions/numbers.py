"""Numeric and date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the date layout of the raw sales files, month/day/year with or
# without leading zeros.
RAW_DATE = r"^\d{1,2}/\d{1,2}/\d{4}$"


def whole(column: Column) -> Column:
    """Whole currency units, cut towards zero."""
    return column.cast("bigint")


def round_half_even(column: Column) -> Column:
    return F.bround(column).cast("bigint")


def percent(part: Column, total: Column) -> Column:
    """`part` as a percentage of `total` to one place; null where the total is 0."""
    return F.round(F.try_divide(part.cast("double"), total.cast("double")) * 100, 1)


def raw_date(column: Column) -> Column:
    """Date of a raw file; anything that is not one becomes null instead of failing.

    Puts the parts in ISO order for the cast, which costs a fraction of a
    pattern parser and, unlike that, raises nothing inside on unreadable text.
    """
    parts = F.split(column, "/")
    iso = F.concat_ws("-", F.get(parts, F.lit(2)), F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))
    return F.when(column.rlike(RAW_DATE), iso.try_cast("date"))


def or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))
