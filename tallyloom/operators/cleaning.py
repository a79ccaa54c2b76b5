"""Projections and filters that bring a relation into its declared shape."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.names import quoted
from tallyloom.functions.text import strip
from tallyloom.periods import period_key, period_of


def conform(df: DataFrame, schema: T.StructType, *, dirty: bool = False) -> DataFrame:
    """Exactly the columns of `schema`: pruned, ordered, cast, strings stripped.

    A value that does not fit its type fails the job, or becomes null with
    `dirty=True`.
    """
    columns = []
    for field in schema.fields:
        column = F.col(quoted(field.name))
        column = column.try_cast(field.dataType) if dirty else column.cast(field.dataType)
        if isinstance(field.dataType, T.StringType):
            column = strip(column)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def strip_strings(df: DataFrame) -> DataFrame:
    """Strip every string column and leave the others alone."""
    return df.withColumns(
        {
            field.name: strip(F.col(quoted(field.name)))
            for field in df.schema.fields
            if isinstance(field.dataType, T.StringType)
        }
    )


def with_period(df: DataFrame, *, keep_parts: bool = False) -> DataFrame:
    """Add ``YEARMONTH``, replacing YEAR and MONTH unless told to keep them."""
    df = df.withColumn("YEARMONTH", period_key())
    return df if keep_parts else df.drop("YEAR", "MONTH")


def look_back(df: DataFrame, as_of: date, years: int = 3) -> DataFrame:
    """Rows from January `years` years ago up to the last complete month.

    Both conditions use only YEAR and MONTH, so they prune directories of a
    table partitioned by those columns.
    """
    return df.filter(
        (F.col("YEAR") >= as_of.year - years)
        & (F.col("YEAR") <= as_of.year)
        & (period_key() < period_of(as_of))
    )


def exclude_customer(df: DataFrame, pattern: str, name: str = "NAMECUST") -> DataFrame:
    """Drop rows whose customer matches a LIKE pattern; nameless rows stay."""
    return df.filter(F.col(name).isNull() | ~F.col(name).like(pattern))


def fill_nulls(df: DataFrame, zero: Sequence[str] = (), empty: Sequence[str] = ()) -> DataFrame:
    """0 for the columns in `zero`, "" for those in `empty`."""
    fills = {name: "0" for name in zero} | {name: "''" for name in empty}
    return df.selectExpr(
        *(
            f"coalesce({quoted(name)}, {fills[name]}) AS {quoted(name)}"
            if name in fills
            else quoted(name)
            for name in df.columns
        )
    )


def whole_numbers(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Cut every numeric column but those in `keep` to bigint, nulls to 0."""
    return df.selectExpr(
        *(
            f"coalesce(cast({quoted(f.name)} AS bigint), 0L) AS {quoted(f.name)}"
            if isinstance(f.dataType, T.NumericType) and f.name not in keep
            else quoted(f.name)
            for f in df.schema.fields
        )
    )


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))
