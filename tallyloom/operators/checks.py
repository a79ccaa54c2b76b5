"""Data-quality checks. Each one is a DataFrame, so it can be stored or tested."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tallyloom.functions.names import all_quoted, quoted
from tallyloom.functions.text import is_invalid_isbn


def _exact(column: Column) -> Column:
    return column.cast("decimal(38,4)")


def _totals(measures: Mapping[str, Column]) -> list[Column]:
    return [
        F.coalesce(_exact(F.sum(column)), _exact(F.lit(0))).alias(name)
        for name, column in measures.items()
    ]


def totals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its sum, and one with the number of rows."""
    measures = {name: F.col(quoted(name)) for name in columns}
    wide = df.agg(_exact(F.count(F.lit(1))).alias("N_ROWS"), *_totals(measures))
    return wide.unpivot([], ["N_ROWS", *columns], "CHECK_NAME", "TOTAL")


def control_totals(
    before: DataFrame, after: DataFrame, columns: Mapping[str, str] | Sequence[str]
) -> DataFrame:
    """Sums of the same measures before and after a step, and their difference.

    `columns` maps a column of `before` to one of `after`. Each side is one
    aggregate; only their single rows meet.
    """
    pairs = dict(columns) if isinstance(columns, Mapping) else {name: name for name in columns}

    def tall(df: DataFrame, names: Mapping[str, str], label: str) -> DataFrame:
        measures = {check: F.col(quoted(name)) for check, name in names.items()}
        wide = df.agg(*_totals(measures))
        return wide.unpivot([], list(names), "CHECK_NAME", label)

    first = tall(before, {name: name for name in pairs}, "BEFORE")
    second = tall(after, pairs, "AFTER")
    sides = first.withColumn("AFTER", F.lit(None).cast("decimal(38,4)")).unionByName(
        second.withColumn("BEFORE", F.lit(None).cast("decimal(38,4)"))
    )
    return (
        sides.groupBy("CHECK_NAME")
        .agg(F.max("BEFORE").alias("BEFORE"), F.max("AFTER").alias("AFTER"))
        .withColumn("DIFFERENCE", F.col("AFTER") - F.col("BEFORE"))
    )


def observe_totals(
    df: DataFrame, name: str, columns: Sequence[str]
) -> tuple[DataFrame, Observation]:
    """`df` that reports its row count and sums to an Observation when it runs.

    Gives the control totals of a write without a second pass over the data.
    """
    observation = Observation(name)
    measures = {column: F.col(quoted(column)) for column in columns}
    watched = df.observe(observation, F.count(F.lit(1)).alias("N_ROWS"), *_totals(measures))
    return watched, observation


def invalid_keys(df: DataFrame, key: str = "ISBN") -> DataFrame:
    """Each key that is missing or not 13 characters long, with its row count."""
    return (
        df.filter(is_invalid_isbn(F.col(quoted(key))))
        .groupBy(F.col(quoted(key)))
        .agg(F.count(F.lit(1)).alias("N_ROWS"))
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of nulls per column, one row each."""
    wide = df.agg(*(F.count_if(F.col(quoted(name)).isNull()).alias(name) for name in columns))
    return wide.unpivot([], list(columns), "COLUMN_NAME", "N_NULLS")


def sign_profile(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Rows and sum per measure and sign class, in one pass.

    A row has a sign in each measure; conditional sums keep that in a single
    aggregate without repeating the rows.
    """
    # Names of the sign classes.
    classes = {
        "NEGATIVE": lambda c: c < 0,
        "ZERO": lambda c: c == 0,
        "POSITIVE": lambda c: c > 0,
    }
    cells = []
    for measure in measures:
        column = F.col(quoted(measure))
        for label, test in classes.items():
            total = F.sum(F.when(test(column), column))
            cells.append(
                F.struct(
                    F.lit(measure).alias("MEASURE"),
                    F.lit(label).alias("SIGN"),
                    F.count_if(test(column)).alias("N_ROWS"),
                    F.coalesce(_exact(total), _exact(F.lit(0))).alias("TOTAL"),
                )
            )
    return df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))


def sample_rows(df: DataFrame, condition: Column, order: Sequence[str], count: int = 5) -> DataFrame:
    """The first `count` rows that meet a condition, as a report for the reader."""
    return df.filter(condition).orderBy(*(F.col(quoted(name)) for name in order)).limit(count)


def sign_samples(
    df: DataFrame, measures: Sequence[str], order: Sequence[str], count: int = 5
) -> DataFrame:
    """`count` rows below and above 0 for each measure, with MEASURE and SIGN before them.

    One pass: a row stands once for each measure in which it isn't 0, and ranks are
    limited in each task before anything moves.
    """
    signs = []
    for measure in measures:
        value = F.col(quoted(measure))
        sign = F.when(value < 0, F.lit("NEGATIVE")).when(value > 0, F.lit("POSITIVE"))
        signs.append(F.struct(F.lit(measure).alias("MEASURE"), sign.alias("SIGN")))
    classes = F.filter(F.array(*signs), lambda x: x["SIGN"].isNotNull())
    first = Window.partitionBy("MEASURE", "SIGN").orderBy(*(F.col(quoted(name)) for name in order))
    return (
        df.select(F.inline(classes), *all_quoted(df.columns))
        .withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") <= count)
        .drop("_rank")
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, matched by column name; duplicates stay."""
    return reduce(DataFrame.unionByName, frames)
