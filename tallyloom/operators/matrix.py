"""The period matrix: one row per key, one column per period bucket.

All buckets of a report come out of a single ``groupBy``: one scan, one
shuffle, partial sums on the map side. A key that holds a large share of the
rows is reduced to one row per map task before anything moves.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date
from itertools import pairwise
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.names import all_quoted, quoted
from tallyloom.periods import (
    month_label,
    months_before,
    next_period,
    period_key,
    period_of,
    prior_years,
    trailing_months,
    year_span,
    ytd_span,
)


class Bucket(NamedTuple):
    """Sum of `measure` over the periods `first` to `last`, both included."""

    name: str
    measure: str
    first: int
    last: int


def ytd(as_of: date, columns: Mapping[str, str]) -> list[Bucket]:
    """Year to date; `columns` maps measure to output column."""
    return [Bucket(name, measure, *ytd_span(as_of)) for measure, name in columns.items()]


def monthly(as_of: date, measure: str, style: str, count: int = 12) -> list[Bucket]:
    """One bucket per complete month, newest first, named by a label style."""
    return [
        Bucket(month_label(period, style), measure, period, period)
        for period in trailing_months(as_of, count)
    ]


def trailing(as_of: date, count: int, columns: Mapping[str, str]) -> list[Bucket]:
    """The last `count` complete months as one sum."""
    span = months_before(as_of, count), months_before(as_of, 1)
    return [Bucket(name, measure, *span) for measure, name in columns.items()]


def yearly(as_of: date, measure: str, style: str, count: int = 3) -> list[Bucket]:
    """One bucket per complete calendar year, newest first."""
    return [
        Bucket(style.format(yyyy=year), measure, *year_span(year))
        for year in prior_years(as_of, count)
    ]


def complete_months(df: DataFrame, as_of: date) -> DataFrame:
    """Rows before the month of `as_of`; that month and later ones are incomplete."""
    return df.filter(period_key() < period_of(as_of))


def _slices(buckets: Sequence[Bucket]) -> dict[tuple[str, int, int], str]:
    """Disjoint spans per measure from which every bucket can be added up.

    Buckets overlap (a month is also part of the year to date and of the
    rolling sums). Summing the disjoint spans and adding those afterwards makes
    the shuffled row narrower, and an input row enters only one sum per
    measure. Spans are half-open: the third key part is the period after.
    """
    names: dict[tuple[str, int, int], str] = {}
    for measure in dict.fromkeys(bucket.measure for bucket in buckets):
        spans = [_half_open(b) for b in buckets if b.measure == measure and b.first <= b.last]
        edges = sorted({edge for span in spans for edge in span})
        for low, after in pairwise(edges):
            if any(first <= low and after <= end for first, end in spans):
                names[measure, low, after] = f"_slice_{len(names)}"
    return names


def _half_open(bucket: Bucket) -> tuple[int, int]:
    return bucket.first, next_period(bucket.last)


def _sum_of(measure: str, low: int, after: int) -> str:
    span = f"= {low}" if next_period(low) == after else f">= {low} AND _period < {after}"
    return f"coalesce(sum({quoted(measure)}) FILTER (WHERE _period {span}), 0)"


def period_matrix(
    df: DataFrame,
    keys: Sequence[str],
    buckets: Sequence[Bucket],
    as_of: date,
    *,
    null_keys: str = "keep",
    carry: Mapping[str, Column] | None = None,
    smallest: Mapping[str, str] | None = None,
) -> DataFrame:
    """Sum every bucket per distinct key of the complete months in `df`.

    `df` has integer YEAR and MONTH, the keys and the measures. Keys without
    sales in any bucket stay, empty buckets are 0. `null_keys="zero"` turns the
    buckets of rows with a null key to 0 (see :func:`zero_null_keys`). `carry`
    adds further aggregates. `smallest` adds the least value of text columns: those
    can't be hash-aggregated, so they join the key first and the minimum is taken
    over the sums, not over the sales.
    """
    check_null_keys(null_keys)
    carry, smallest = carry or {}, smallest or {}
    if carry and smallest:
        raise ValueError("carry and smallest are for different matrices")
    slices = _slices(buckets)
    rows = complete_months(df, as_of).withColumn("_period", period_key())
    columns = all_quoted([*keys, *smallest.values()])
    sums = [
        *(F.expr(_sum_of(*span)).alias(name) for span, name in slices.items()),
        *(column.alias(name) for name, column in carry.items()),
    ]
    totals = rows.groupBy(*columns).agg(*sums) if sums else rows.select(*columns).distinct()
    if smallest:
        totals = totals.groupBy(*all_quoted(keys)).agg(
            *(F.sum(name).alias(name) for name in slices.values()),
            *(F.min(F.col(quoted(text))).alias(name) for name, text in smallest.items()),
        )
    kinds = {field.name: field.dataType for field in df.schema.fields}

    def total(bucket: Bucket) -> str:
        first, end = _half_open(bucket)
        parts = [
            name
            for (measure, low, after), name in slices.items()
            if measure == bucket.measure and first <= low and after <= end
        ]
        # An empty span (the year to date in January) has no parts. The cast
        # undoes the digit that each addition of decimals adds to their type.
        kind = _sum_type(kinds[bucket.measure]).simpleString()
        return f"cast({' + '.join(parts) or 0} AS {kind}) AS {quoted(bucket.name)}"

    carried = all_quoted([*carry, *smallest])
    matrix = totals.selectExpr(*all_quoted(keys), *map(total, buckets), *carried)
    if null_keys == "zero":
        matrix = zero_null_keys(matrix, keys, [bucket.name for bucket in buckets])
    return matrix


def _sum_type(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(min(kind.precision + 10, 38), kind.scale)
    return T.LongType() if isinstance(kind, T.IntegralType) else T.DoubleType()


def check_null_keys(mode: str) -> None:
    if mode not in ("keep", "zero"):
        raise ValueError(f"null_keys is 'keep' or 'zero', not {mode!r}")


def zero_null_keys(df: DataFrame, keys: Iterable[str], columns: Sequence[str]) -> DataFrame:
    """0 in `columns` wherever any key is null; the rows themselves stay."""
    missing = " OR ".join(f"{quoted(key)} IS NULL" for key in keys)
    return df.selectExpr(
        *(
            f"if({missing}, cast(0 AS {field.dataType.simpleString()}), {quoted(field.name)})"
            f" AS {quoted(field.name)}"
            if field.name in columns
            else quoted(field.name)
            for field in df.schema.fields
        )
    )


def coarse_totals(
    matrix: DataFrame, keys: Sequence[str], columns: Mapping[str, str]
) -> DataFrame:
    """Columns of a finished matrix added up at a coarser grain, one row per `keys`.

    The matrix has far fewer rows than the sales it was made of, and its rows are
    combined before they move. Give it as stored (see `written`), since whatever
    the totals are joined to reads it as well, and before null keys are zeroed.
    """
    return matrix.groupBy(*all_quoted(keys)).agg(
        *(
            F.expr(f"coalesce(sum({quoted(column)}), 0)").alias(name)
            for column, name in columns.items()
        )
    )


def money_as_double(df: DataFrame) -> DataFrame:
    """Decimal columns to double, the type report columns have."""
    return df.selectExpr(
        *(
            f"cast({quoted(f.name)} AS double) AS {quoted(f.name)}"
            if isinstance(f.dataType, T.DecimalType)
            else quoted(f.name)
            for f in df.schema.fields
        )
    )
