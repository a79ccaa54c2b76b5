"""Targets per account and customers that buy through both channels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.names import quoted
from tallyloom.functions.text import mark_shared, strip
from tallyloom.operators.lookups import lookup

# A ratio keeps ten decimals, enough for a spreadsheet quotient.
RATIO = T.DecimalType(16, 10)
TARGET = T.DecimalType(18, 4)


def usable_targets(targets: DataFrame, target_year: int) -> DataFrame:
    """Accounts with a ratio other than 0, as ACCOUNT, RATIO and TARGET.

    An account listed more than once is not resolved here: every lookup takes
    the first row per key, and `duplicate_keys` reports the others.
    """
    account = strip(F.col("BILLTO").cast("string"))
    return targets.select(
        account.alias("ACCOUNT"),
        F.col("MUL_RATIO").cast(RATIO).alias("RATIO"),
        F.col(quoted(target_year)).cast(TARGET).alias("TARGET"),
    ).filter((F.col("ACCOUNT") != "") & (F.col("RATIO") != 0))


def scale_targets(
    df: DataFrame,
    targets: DataFrame,
    account: str,
    amounts: dict[str, str],
    target_column: str,
) -> DataFrame:
    """Add the account's target and, per entry of `amounts`, a scaled amount.

    `amounts` maps a column of absolute amounts to its scaled name. The size of
    a scaled amount is ``abs(amount * ratio)``, which for a fixed account is
    ``abs(amount) * abs(ratio)``; absolute amounts can therefore be added up
    before this join, which then runs on accounts instead of sales rows. An
    account without target keeps its amounts (ratio 1) and has target null.
    """
    ratio = F.abs(F.coalesce(F.col("RATIO"), F.lit(1).cast(RATIO)))
    return (
        lookup(df, targets, {account: "ACCOUNT"})
        .withColumns(
            {
                scaled: (F.col(quoted(amount)).cast(T.DecimalType(18, 0)) * ratio)
                for amount, scaled in amounts.items()
            }
        )
        .withColumnRenamed("TARGET", target_column)
        .drop("RATIO")
    )


def flag_shared(
    df: DataFrame, name: str, lowest: str, highest: str, *, flag: str = "IS_SHARED"
) -> DataFrame:
    """Flag customers whose rows span more than one channel.

    `lowest` and `highest` hold the smallest and largest channel of a row. The
    input is already grouped by customer and category, so the window sees one
    row per category of a customer, however many sales stand behind it.
    """
    per_name = Window.partitionBy(F.col(quoted(name)))
    spans = F.min(F.col(lowest)).over(per_name) != F.max(F.col(highest)).over(per_name)
    return df.withColumn(flag, spans).drop(lowest, highest)


def shared_customers(
    facts: Sequence[DataFrame], name: str = "NAMECUST"
) -> DataFrame:
    """Names that occur in each of `facts`, once."""
    names = [df.select(F.col(quoted(name))).distinct() for df in facts]
    common = names[0]
    for other in names[1:]:
        common = common.intersect(other)
    return common


def with_mark(df: DataFrame, name: str, flag: str = "IS_SHARED") -> DataFrame:
    """Append the shared mark to flagged names and drop the flag."""
    marked = F.when(F.col(flag), mark_shared(F.col(quoted(name)))).otherwise(F.col(quoted(name)))
    return df.withColumn(name, marked).drop(flag)
