"""The two channels as the reports take them, from monthly sums and maps."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.cleaning import conform, exclude_customer, look_back
from tallyloom.operators.lookups import lookup, map_names
from tallyloom.plans.distributor import add_category
from tallyloom.plans.monthly import SHAPE_A, SHAPE_S, SIZE, WHOLE, accounts_of, monthly_sums
from tallyloom.sources.schemas import CATEGORY_MAP_S, NAME_MAP, SALES_A, SALES_S
from tallyloom.sources.sinks import written


def with_accounts(sums: DataFrame, accounts: DataFrame, keys: list[str]) -> DataFrame:
    """What is known of an account, on each of its sums. Accounts are stored first."""
    return lookup(sums, written(accounts, "accounts"), keys, unique=True, null_safe=True)


def mapped_a(sums: DataFrame, categories: DataFrame, names: DataFrame) -> DataFrame:
    """Distributor sums with category and canonical customer names.

    The maps are met by the accounts that occur, not by sales or sums.
    """
    accounts = accounts_of(sums, SHAPE_A)
    keys = accounts.columns
    known = accounts.withColumn("_name", F.col("NAMECUST"))
    known = map_names(add_category(known, categories), conform(names, NAME_MAP), "_name")
    facts = with_accounts(sums, known, keys).drop("NAMECUST")
    return facts.withColumnsRenamed(
        {"HQ Account Number": "HQ_NUMBER", "SL Account Number": "SL_NUMBER", "_name": "NAMECUST"}
    ).select(*SALES_A.names, WHOLE, SIZE)


def mapped_s(sums: DataFrame, categories: DataFrame, *, without: str | None = None) -> DataFrame:
    """Direct sums with category, without the customer that is the distributor."""
    if without is not None:
        sums = exclude_customer(sums, without)
    accounts = accounts_of(sums, SHAPE_S).select("NEWBILLTO").distinct()
    known = lookup(accounts, conform(categories, CATEGORY_MAP_S), {"NEWBILLTO": "BILLTO"})
    facts = with_accounts(sums, known, ["NEWBILLTO"])
    return facts.withColumnsRenamed(
        {"NEWBILLTO": "ACCOUNT_ID", "MASTER SALES CATEGORY": "SALES_CATEGORY"}
    ).select(*SALES_S.names, WHOLE, SIZE)


def channel_a(
    stored: DataFrame, categories: DataFrame, names: DataFrame, as_of: date
) -> DataFrame:
    """Distributor sales of the look-back window, added up by month and mapped."""
    sums = written(monthly_sums(look_back(stored, as_of), SHAPE_A), "sums")
    return mapped_a(sums, categories, names)


def channel_s(
    stored: DataFrame, categories: DataFrame, as_of: date, *, without: str | None = None
) -> DataFrame:
    """Direct sales of the look-back window, added up by month and mapped."""
    sums = written(monthly_sums(look_back(stored, as_of), SHAPE_S), "sums")
    return mapped_s(sums, categories, without=without)
