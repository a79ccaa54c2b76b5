"""Revenue by title, with stock and backorders."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numbers import whole
from tallyloom.functions.text import strip
from tallyloom.operators.cleaning import conform, look_back
from tallyloom.operators.lookups import lookup
from tallyloom.operators.matrix import (
    Bucket,
    money_as_double,
    monthly,
    period_matrix,
    trailing,
    yearly,
    ytd,
)
from tallyloom.periods import period_key, ytd_span
from tallyloom.sources.schemas import BOOK_LEVEL_SALES

KEYS = ["ISBN", "TITLE"]


def buckets(as_of: date) -> list[Bucket]:
    units, dollars = "NETQTY", "NETAMT"
    return [
        *ytd(as_of, {dollars: "YTD_DOLLARS", units: "YTD_UNITS"}),
        *monthly(as_of, units, "{mon}-{yy}"),
        *yearly(as_of, units, "{yyyy}-UNITS"),
        *trailing(as_of, 12, {units: "12M_UNITS", dollars: "12M_DOLLARS"}),
    ]


def product_columns(products: DataFrame) -> DataFrame:
    return products.select(
        strip(F.col("ISBN").cast("string")).alias("ISBN"),
        strip(F.col("PROD_TYPE")).alias("PROD_TYPE"),
        strip(F.col("SEAS")).alias("SEASON"),
        strip(F.col("SUB_PUB")).alias("SUB_PUB"),
        "RETAIL_PRICE",
        "QTY_ON_HAND",
        "QTY_ON_ORDER",
    )


def title_matrix(
    sales: DataFrame, as_of: date, *, active_only: bool = True, whole_amounts: bool = True
) -> DataFrame:
    """Period sums per product and title.

    `active_only` leaves out titles without a sale in the year to date.
    `whole_amounts` cuts each amount to whole currency units before adding.
    """
    facts = look_back(conform(sales, BOOK_LEVEL_SALES), as_of)
    if whole_amounts:
        facts = facts.withColumn("NETAMT", whole(F.col("NETAMT")))
    if not active_only:
        return period_matrix(facts, KEYS, buckets(as_of), as_of)
    in_ytd = F.count_if(period_key().between(*ytd_span(as_of)))
    matrix = period_matrix(facts, KEYS, buckets(as_of), as_of, carry={"_ytd_rows": in_ytd})
    return matrix.filter("_ytd_rows > 0").drop("_ytd_rows")


def report_titles(
    sales: DataFrame,
    products: DataFrame,
    backorders: DataFrame,
    as_of: date,
    *,
    active_only: bool = True,
    whole_amounts: bool = True,
) -> DataFrame:
    """Units and dollars per product and title, with stock and backorders.

    Products and backorders are found by product key; the backorders of a
    product are added up over its titles. See `title_matrix` for the options.
    """
    matrix = title_matrix(sales, as_of, active_only=active_only, whole_amounts=whole_amounts)
    report = lookup(matrix, product_columns(products), ["ISBN"])
    waiting = (
        backorders.select(strip(F.col("ISBN").cast("string")).alias("ISBN"), "QTY")
        .groupBy("ISBN")
        .agg(F.sum("QTY").alias("QTYBO"))
    )
    report = lookup(report, waiting, ["ISBN"], unique=True, measured=False)
    return money_as_double(report)
