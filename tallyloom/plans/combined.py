"""Both channels by product, customer and category."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.names import all_quoted
from tallyloom.functions.text import strip, strip_hyphens
from tallyloom.operators.checks import union_all
from tallyloom.operators.cleaning import conform, fill_nulls, look_back
from tallyloom.operators.lookups import lookup
from tallyloom.operators.matrix import (
    Bucket,
    check_null_keys,
    coarse_totals,
    money_as_double,
    monthly,
    period_matrix,
    trailing,
    yearly,
    ytd,
    zero_null_keys,
)
from tallyloom.sources.schemas import SALES
from tallyloom.sources.sinks import written

# The key of the report, and below the order of its columns.
KEYS = ["ISBN", "TITLE", "NAMECUST", "SALES_CATEGORY"]
# A number of the product key, so that rows move once for all that is looked up by it.
PLACE = "_place"


def facts_of(sales_a: DataFrame, sales_s: DataFrame) -> DataFrame:
    """Both channels in one shape, with hyphens out of the product key.

    Normalising the key before the grouping makes a second grouping of the
    finished report unnecessary.
    """
    both = union_all([conform(sales_a, SALES), conform(sales_s, SALES)])
    return both.withColumn("ISBN", strip_hyphens(F.col("ISBN")))


def buckets(as_of: date) -> list[Bucket]:
    units, dollars = "NETUNITS", "NETAMT"
    return [
        *trailing(as_of, 12, {units: "12M_UNITS", dollars: "12M_DOLLARS"}),
        *ytd(as_of, {units: "YTD_UNITS", dollars: "YTD_DOLLARS"}),
        *monthly(as_of, units, "NET_UNITS_{mon}_{yyyy}"),
        *yearly(as_of, units, "UNITS_{yyyy}"),
        *trailing(as_of, 4, {units: "4M_UNITS", dollars: "4M_DOLLARS"}),
    ]


def product_columns(products: DataFrame) -> DataFrame:
    return products.select(
        strip_hyphens(strip(F.col("ISBN").cast("string"))).alias("ISBN"),
        F.col("PROD_TYPE").alias("TYPE"),
        F.col("PROD_CLASS").alias("PROD"),
        strip(F.col("WEBCAT2")).alias("WEBCAT2"),
        strip(F.col("WEBCAT2_DESCR")).alias("WEBCAT2_DESCR"),
        F.col("SUB_PUB").alias("SUB"),
        F.col("PUB_STATUS"),
        F.col("RETAIL_PRICE").alias("RETAIL"),
        F.col("SEAS"),
    )


def rollup_columns(rollup: DataFrame) -> DataFrame:
    return rollup.select(
        strip_hyphens(strip(F.col("ITEMNO").cast("string"))).alias("ISBN"),
        F.col("NETQTY").alias("ALL_ACCTS_12M_UNITS"),
        F.col("NETSALES").alias("ALL_ACCTS_12M_DOLLARS"),
    )


def report_combined(
    sales_a: DataFrame,
    sales_s: DataFrame,
    rollup: DataFrame | None,
    products: DataFrame,
    as_of: date,
    *,
    null_keys: str = "keep",
) -> DataFrame:
    """Units and dollars of both channels, one row per `KEYS`.

    Only sales of the look-back window count, whatever the relations hold.
    `rollup` holds the rolling 12 months of all accounts per product; without
    it they are added up from the finished matrix, which is stored for that, so
    that the sales are read once.
    """
    check_null_keys(null_keys)
    facts = look_back(facts_of(sales_a, sales_s), as_of)
    periods = buckets(as_of)
    report = period_matrix(facts, KEYS, periods, as_of)
    if rollup is None:
        report = written(report, "combined-matrix")
        everyone = coarse_totals(
            report,
            ["ISBN"],
            {"12M_UNITS": "ALL_ACCTS_12M_UNITS", "12M_DOLLARS": "ALL_ACCTS_12M_DOLLARS"},
        )
    if null_keys == "zero":
        report = zero_null_keys(report, KEYS, [bucket.name for bucket in periods])
    if rollup is None:
        report = lookup(report, everyone, ["ISBN"], unique=True, measured=False, place=PLACE)
    else:
        report = lookup(report, rollup_columns(rollup), ["ISBN"], place=PLACE)
    report = lookup(report, product_columns(products), ["ISBN"], place=PLACE)
    report = fill_nulls(
        report,
        zero=["ALL_ACCTS_12M_UNITS", "ALL_ACCTS_12M_DOLLARS", "RETAIL"],
        empty=["TYPE", "PROD", "SEAS", "SUB", "WEBCAT2", "WEBCAT2_DESCR"],
    )
    order = [
        "TITLE", "ISBN", "NAMECUST", "SALES_CATEGORY",
        "TYPE", "PROD", "WEBCAT2", "WEBCAT2_DESCR", "SUB", "PUB_STATUS", "RETAIL", "SEAS",
        "ALL_ACCTS_12M_UNITS", "ALL_ACCTS_12M_DOLLARS",
        *(bucket.name for bucket in periods),
    ]
    return money_as_double(report.select(*all_quoted(order)))
