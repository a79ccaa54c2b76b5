"""The distributor channel alone, down to its accounts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.names import all_quoted
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
from tallyloom.sources.schemas import CATEGORY_MAP_A, PRODUCTS, STORED_SALES
from tallyloom.sources.sinks import written

# The key of the report, the product columns it shows, and further
# down the order of its columns.
KEYS = ["ISBN", "TITLE", "NAMECUST", "HQ Account Number", "SL Account Number", "IPS Sale"]
FACT = T.StructType([f for f in STORED_SALES.fields if f.name != "SL Class of Trade"])
PRODUCT_COLUMNS = T.StructType(
    [
        PRODUCTS[name]
        for name in (
            "ISBN", "PROD_TYPE", "PROD_CLASS", "SEAS", "SUB_PUB", "WEBCAT2", "WEBCAT2_DESCR",
            "RETAIL_PRICE",
        )
    ]
)


def buckets(as_of: date) -> list[Bucket]:
    units, dollars = "NETUNITS", "NETAMT"
    return [
        *trailing(as_of, 12, {units: "12M_UNITS", dollars: "12M_DOLLARS"}),
        *ytd(as_of, {units: "YTD_UNITS", dollars: "YTD_DOLLARS"}),
        *monthly(as_of, units, "NET_UNITS_{mon}_{yyyy}"),
        *yearly(as_of, units, "NET_UNITS_{yyyy}"),
    ]


def add_category(df: DataFrame, categories: DataFrame) -> DataFrame:
    """SALES_CATEGORY of the (ship-to, parent) account pair, null if unmapped."""
    pair = ["SL Account Number", "HQ Account Number"]
    return lookup(df, conform(categories, CATEGORY_MAP_A), pair).withColumnRenamed(
        "MASTER SALES CATEGORY", "SALES_CATEGORY"
    )


def report_distributor(
    sales_a: DataFrame,
    categories: DataFrame,
    products: DataFrame,
    as_of: date,
    *,
    null_keys: str = "keep",
) -> DataFrame:
    """Units and dollars per product, customer, account pair and sale type.

    The category follows from the account pair, which is part of the key, so
    it is looked up once per finished row instead of once per sale. The matrix
    is stored, since its totals by title are joined back to it.
    """
    check_null_keys(null_keys)
    facts = look_back(conform(sales_a, FACT), as_of)
    periods = buckets(as_of)
    matrix = written(period_matrix(facts, KEYS, periods, as_of), "distributor-matrix")
    report = add_category(matrix, categories)
    if null_keys == "zero":
        names = [bucket.name for bucket in periods]
        report = zero_null_keys(report, [*KEYS, "SALES_CATEGORY"], names)
    everyone = coarse_totals(
        matrix,
        ["ISBN", "TITLE"],
        {"12M_UNITS": "ALL_ACCTS_12M_UNITS", "12M_DOLLARS": "ALL_ACCTS_12M_DOLLARS"},
    )
    report = lookup(
        report,
        everyone,
        ["ISBN", "TITLE"],
        unique=True,
        measured=False,
        null_safe=null_keys == "keep",
    )
    report = lookup(report, conform(products, PRODUCT_COLUMNS), ["ISBN"])
    report = fill_nulls(
        report.withColumnRenamed("SUB_PUB", "SUBPUB"),
        zero=["ALL_ACCTS_12M_UNITS", "ALL_ACCTS_12M_DOLLARS", "RETAIL_PRICE"],
    )
    order = [
        "NAMECUST", "HQ Account Number", "SL Account Number", "IPS Sale", "SALES_CATEGORY",
        "ISBN", "TITLE",
        "PROD_TYPE", "PROD_CLASS", "SEAS", "SUBPUB", "WEBCAT2", "WEBCAT2_DESCR", "RETAIL_PRICE",
        *(bucket.name for bucket in periods[:4]),
        "ALL_ACCTS_12M_UNITS", "ALL_ACCTS_12M_DOLLARS",
        *(bucket.name for bucket in periods[4:]),
    ]
    return money_as_double(report.select(*all_quoted(order)))
