"""Target against actual, by customer and category over both channels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.names import all_quoted, quoted
from tallyloom.functions.numbers import or_zero, percent, whole
from tallyloom.functions.text import strip, strip_name_mark
from tallyloom.operators.checks import union_all
from tallyloom.operators.cleaning import conform, look_back, whole_numbers
from tallyloom.operators.lookups import lookup
from tallyloom.operators.matrix import (
    Bucket,
    monthly,
    period_matrix,
    trailing,
    yearly,
    ytd,
)
from tallyloom.operators.targets import flag_shared, scale_targets, usable_targets, with_mark
from tallyloom.periods import month_label, trailing_months
from tallyloom.plans.monthly import SIZE, WHOLE
from tallyloom.sources.schemas import SALES_A, SALES_S

# Channels are numbers, which a hash aggregation can take the smallest of.
CHANNEL_A, CHANNEL_S = 1, 2


def facts_of(sales_a: DataFrame, sales_s: DataFrame) -> DataFrame:
    """Both channels by account, with amounts cut to whole currency units.

    Amounts are cut sale by sale; monthly sums bring theirs along. A target is scaled from
    absolute amounts, see `scale_targets`.
    """

    def channel(df: DataFrame, schema: T.StructType, number: int, account: str) -> DataFrame:
        if WHOLE in df.columns:
            amount, size = F.col(WHOLE), F.col(SIZE)
            schema = T.StructType([*schema.fields, df.schema[WHOLE], df.schema[SIZE]])
        else:
            amount = whole(F.col("NETAMT"))
            size = F.abs(amount)
        return conform(df, schema).select(
            F.lit(number).alias("CHANNEL"),
            F.col(account).alias("ACCOUNT"),
            "NAMECUST",
            "SALES_CATEGORY",
            "YEAR",
            "MONTH",
            amount.alias("NETAMT"),
            size.alias(SIZE),
        )

    return union_all(
        [
            channel(sales_a, SALES_A, CHANNEL_A, "HQ_NUMBER"),
            channel(sales_s, SALES_S, CHANNEL_S, "ACCOUNT_ID"),
        ]
    )


def actual_buckets(as_of: date) -> list[Bucket]:
    return [
        *monthly(as_of, "NETAMT", "{mon}_{yy} Actual"),
        *trailing(as_of, 12, {"NETAMT": "12M_ROLLING_ACTUAL"}),
        *ytd(as_of, {"NETAMT": "YTD_ACTUAL"}),
        *yearly(as_of, "NETAMT", "{yyyy}_ACTUAL", 2),
    ]


def target_buckets(as_of: date) -> list[Bucket]:
    return [
        *monthly(as_of, SIZE, "{mon}_{yy} Target", 1),
        *ytd(as_of, {SIZE: "YTD_TARGET"}),
    ]


def add_city_state(df: DataFrame, locations: DataFrame, customer: str) -> DataFrame:
    """CITY and STATE of a customer, found by the name without its mark."""
    places = locations.select(
        strip(F.col("NAMECUST")).alias("_place_of"),
        strip(F.col("NAMECITY")).alias("CITY"),
        strip(F.col("CODESTTE")).alias("STATE"),
    )
    keyed = df.withColumn("_plain_name", strip_name_mark(F.col(quoted(customer))))
    return lookup(keyed, places, {"_plain_name": "_place_of"}).drop("_plain_name")


def by_customer(
    sales_a: DataFrame,
    sales_s: DataFrame,
    targets: DataFrame,
    as_of: date,
    target_year: int,
    *,
    null_keys: str = "keep",
) -> DataFrame:
    """Actual and target sums per customer and category, before any derived column."""
    actual, scaled = actual_buckets(as_of), target_buckets(as_of)
    account_keys = ["CHANNEL", "ACCOUNT", "NAMECUST", "SALES_CATEGORY"]
    facts = look_back(facts_of(sales_a, sales_s), as_of)
    accounts = period_matrix(
        facts, account_keys, [*actual, *scaled], as_of, null_keys=null_keys
    )
    target_column = f"{target_year}_Target"
    accounts = scale_targets(
        accounts,
        usable_targets(targets, target_year),
        "ACCOUNT",
        {bucket.name: bucket.name for bucket in scaled},
        target_column,
    )
    sums = [target_column, *(bucket.name for bucket in [*actual, *scaled])]
    return accounts.groupBy("NAMECUST", "SALES_CATEGORY").agg(
        *(or_zero(F.sum(F.col(quoted(name)))).alias(name) for name in sums),
        F.min("CHANNEL").alias("_lowest"),
        F.max("CHANNEL").alias("_highest"),
    )


def report_targets(
    sales_a: DataFrame,
    sales_s: DataFrame,
    targets: DataFrame,
    locations: DataFrame,
    as_of: date,
    target_year: int,
    *,
    null_keys: str = "keep",
) -> DataFrame:
    """Capture rate and remaining target per customer and category.

    Customers of both channels carry a mark after their name. The largest
    rolling 12 months come first.
    """
    target_column = f"{target_year}_Target"
    customers = by_customer(
        sales_a, sales_s, targets, as_of, target_year, null_keys=null_keys
    )
    report = customers.withColumns(
        {
            "Capture_Rate": percent(F.col("YTD_ACTUAL"), F.col("YTD_TARGET")),
            "Target_Remaining": F.col(target_column) - F.col("YTD_ACTUAL"),
        }
    )
    report = add_city_state(report, locations, "NAMECUST")
    report = with_mark(flag_shared(report, "NAMECUST", "_lowest", "_highest"), "NAMECUST")
    report = whole_numbers(
        report.withColumnsRenamed({"SALES_CATEGORY": "Category", "NAMECUST": "Customer"}),
        keep=["Capture_Rate"],
    )
    months = [month_label(period, "{mon}_{yy}") for period in trailing_months(as_of)]
    order = [
        "Category", "Customer",
        f"{months[0]} Target",
        *(f"{month} Actual" for month in months),
        "12M_ROLLING_ACTUAL", target_column, "YTD_TARGET", "YTD_ACTUAL",
        "Capture_Rate", "Target_Remaining",
        *(bucket.name for bucket in yearly(as_of, "NETAMT", "{yyyy}_ACTUAL", 2)),
        "CITY", "STATE",
    ]
    return report.select(*all_quoted(order)).orderBy(
        F.col("12M_ROLLING_ACTUAL").desc(), "Customer", "Category"
    )
