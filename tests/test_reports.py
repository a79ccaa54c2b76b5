"""The edge cases that the reports must get right, on a handful of rows."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

import tallyloom as tl
from tallyloom.operators import checks
from tallyloom.operators.lookups import duplicate_keys
from tallyloom.operators.targets import usable_targets
from tallyloom.plans import channels, ingest
from tallyloom.sources import schemas
from tallyloom.sources.readers import empty

AS_OF = date(2001, 8, 15)


@pytest.fixture
def of_a(spark):
    def build(*rows):
        """(HQ, NAMECUST, category, period, amount)"""
        return spark.createDataFrame(
            [
                (hq, f"ship{n}", "1", p // 100, p % 100, "t", name, 1, amount, category)
                for n, (hq, name, category, p, amount) in enumerate(rows)
            ],
            "HQ_NUMBER string, SL_NUMBER string, ISBN string, YEAR int, MONTH int, TITLE string,"
            " NAMECUST string, NETUNITS bigint, NETAMT double, SALES_CATEGORY string",
        )

    return build


@pytest.fixture
def of_s(of_a):
    def build(*rows):
        return of_a(*rows).withColumnRenamed("HQ_NUMBER", "ACCOUNT_ID").drop("SL_NUMBER")

    return build


@pytest.fixture
def targets(spark):
    def build(*rows):
        return spark.createDataFrame(
            list(rows), "BILLTO string, `2025` double, MUL_RATIO double"
        )

    return build


@pytest.fixture
def places(spark):
    return spark.createDataFrame(
        [("N", "Town", "ST"), ("N", "Ville", "ST")],
        "NAMECUST string, NAMECITY string, CODESTTE string",
    )


def run(sales_a, sales_s, targets, places, as_of=AS_OF, **options):
    report = tl.report_targets(sales_a, sales_s, targets, places, as_of, 2025, **options)
    return [row.asDict() for row in report.collect()]


def test_amounts_are_cut_per_row(of_a, of_s, targets, places):
    sales = of_a(("7", "N", "c", 200107, 1.9), ("7", "N", "c", 200107, -1.9),
                 ("7", "N", "c", 200107, 2.5))
    (row,) = run(sales, of_s(), targets(), places)
    assert row["Jul_01 Actual"] == 1 - 1 + 2
    assert row["Jul_01 Target"] == 1 + 1 + 2


def test_duplicate_target_does_not_repeat_facts(of_a, of_s, targets, places, spark):
    listed = targets(("7", 50.0, 1.1), ("7", 90.0, 1.1), ("8", 10.0, 0.0), ("", 1.0, 1.0),
                     (None, 1.0, 1.0), ("9", 5.0, None))
    sales = of_a(("7", "N", "c", 200107, 100.0), ("8", "N", "c", 200106, 100.0))
    (row,) = run(sales, of_s(), listed, places)
    assert row["YTD_ACTUAL"] == 200
    assert row["2025_Target"] == 50
    assert row["YTD_TARGET"] == 110 + 100
    usable = usable_targets(listed, 2025)
    assert [tuple(r) for r in duplicate_keys(usable, ["ACCOUNT"]).collect()] == [("7", 1)]


def test_accounts_with_one_name_are_counted_once(of_a, of_s, targets, places):
    sales = of_s(("1", "N", "c", 200107, 100.0), ("2", "N", "c", 200107, 50.0))
    (row,) = run(of_a(), sales, targets(), places)
    assert row["Jul_01 Actual"] == 150


def test_returns_raise_the_target(of_a, of_s, targets, places):
    (row,) = run(of_a(("7", "N", "c", 200107, -100.0)), of_s(), targets(("7", 0.0, 1.2)), places)
    assert row["Jul_01 Actual"] == -100 and row["Jul_01 Target"] == 120


def test_shared_customer_is_marked_and_still_found(of_a, of_s, targets, places):
    rows = run(of_a(("1", "N*", "c", 200107, 9.0), ("1", "Z", "c", 200107, 1.0)),
               of_s(("2", "N*", "d", 200107, 5.0)), targets(), places)
    assert [(r["Customer"], r["Category"], r["CITY"]) for r in rows] == [
        ("N*~", "c", "Town"), ("N*~", "d", "Town"), ("Z", "c", None),
    ]


def test_zero_target_has_no_rate_and_january_has_a_target_column(of_a, of_s, targets, places):
    sales = of_a(("1", "N", "c", 200012, 10.0))
    (row,) = run(sales, of_s(), targets(), places, date(2001, 1, 10))
    assert row["Capture_Rate"] is None
    assert row["YTD_ACTUAL"] == 0 and row["Dec_00 Target"] == 10
    assert list(row)[:4] == ["Category", "Customer", "Dec_00 Target", "Dec_00 Actual"]


def test_null_category_can_be_zeroed(of_a, of_s, targets, places):
    sales = of_a(("1", "N", None, 200107, 10.0))
    assert run(sales, of_s(), targets(), places)[0]["YTD_ACTUAL"] == 10
    assert run(sales, of_s(), targets(), places, null_keys="zero")[0]["YTD_ACTUAL"] == 0


def test_combined_merges_hyphens_and_ignores_duplicate_products(spark, facts):
    sales_a = facts(("978-0-00-1", "t", "n", "c", 200107, 10, 5))
    sales_s = facts(("9780001", " t\t", "n", "c", 200107, 3, 1.5))
    products = spark.createDataFrame(
        [("978-0001", "x"), ("9780001 ", "y")], "ISBN string, PROD_TYPE string"
    )
    for name in schemas.PRODUCTS.names:
        if name not in products.columns:
            products = products.withColumn(name, F.lit(None).cast(schemas.PRODUCTS[name].dataType))
    rollup = spark.createDataFrame(
        [("978-0001", 99, 9.0), ("9780001", 99, 9.0)], "ITEMNO string, NETQTY bigint, NETSALES double"
    )
    (row,) = tl.report_combined(sales_a, sales_s, rollup, products, AS_OF).collect()
    assert (row["ISBN"], row["12M_UNITS"], row["12M_DOLLARS"]) == ("9780001", 13, 6.5)
    assert (row["TYPE"], row["ALL_ACCTS_12M_UNITS"], row["SUB"], row["RETAIL"]) == ("x", 99, "", 0)
    none = tl.report_combined(
        sales_a, sales_s, empty(spark, schemas.ALL_ACCOUNTS_12M), products.limit(0), AS_OF
    ).first()
    assert (none["ALL_ACCTS_12M_UNITS"], none["TYPE"], none["PUB_STATUS"]) == (0, "", None)


def test_distributor_keeps_unmapped_accounts(spark):
    sales = spark.createDataFrame(
        [("1", "t", "n", "Y", "01", "001", 5, 2.5, "k", 2001, 7),
         ("1", "t", "n", "Y", "01", "002", 1, 1.0, "k", 2001, 7)],
        schemas.STORED_SALES.simpleString().removeprefix("struct<").removesuffix(">")
        .replace("IPS Sale", "`IPS Sale`").replace("HQ Account Number", "`HQ Account Number`")
        .replace("SL Account Number", "`SL Account Number`")
        .replace("SL Class of Trade", "`SL Class of Trade`").replace("decimal(18,4)", "double"),
    )
    categories = spark.createDataFrame(
        [("001 ", "01", "cat"), ("001", "01", "cat"), ("2", "01", "no")], schemas.CATEGORY_MAP_A
    )
    products = empty(spark, schemas.PRODUCTS)
    for mode, units in (("keep", 1), ("zero", 0)):
        rows = {
            row["SL Account Number"]: row
            for row in tl.report_distributor(
                sales, categories, products, AS_OF, null_keys=mode
            ).collect()
        }
        assert rows["001"]["SALES_CATEGORY"] == "cat" and rows["001"]["YTD_UNITS"] == 5
        assert rows["002"]["SALES_CATEGORY"] is None and rows["002"]["12M_UNITS"] == units
        assert {r["ALL_ACCTS_12M_UNITS"] for r in rows.values()} == {6}


def test_titles_active_only(spark):
    sales = spark.createDataFrame(
        [("1", "t", 2001, 7, 1.9, 1), ("1", "t", 2001, 6, 1.9, -1), ("2", "u", 2000, 12, 5.0, 5)],
        "ISBN string, TITLE string, YEAR int, MONTH int, NETAMT double, NETQTY bigint",
    )
    waiting = spark.createDataFrame([("t", "1", 3), ("t2", "1", 4)], "TITLE string, ISBN string, QTY int")
    products = empty(spark, schemas.PRODUCTS)
    (row,) = tl.report_titles(sales, products, waiting, AS_OF).collect()
    assert (row["ISBN"], row["YTD_UNITS"], row["YTD_DOLLARS"], row["QTYBO"]) == ("1", 0, 2, 7)
    every = tl.report_titles(
        sales, products, waiting, AS_OF, active_only=False, whole_amounts=False
    ).collect()
    assert {r["ISBN"]: r["12M_DOLLARS"] for r in every} == {"1": 3.8, "2": 5.0}


def test_backorders(spark):
    of_a = spark.createDataFrame(
        [("1", "t ", 5), ("1", "t", 0), (None, "t", 5), ("2", None, 1)], schemas.RAW_BACKORDERS
    )
    of_s = spark.createDataFrame([(" 1", "t", 2), ("3", "v", 0)], schemas.BACKORDERS_S)
    rows = {tuple(r) for r in tl.combine_backorders(of_a, of_s).collect()}
    assert rows == {("t", "1", 7), ("v", "3", 0)}


@pytest.fixture
def raw(spark):
    def line(**given):
        values = {
            "EAN": "9780001112223", "Title": "t", "Headquarter": "n", "Date": "1/5/2001",
            "Net Sold Units": 1.0, "Net Invc": 1.0, "SL Class of Trade": "k", "IPS Sale": "Y",
            "HQ Account Number": "01", "SL Account Number": "001",
        }
        values |= {key.replace("_", " "): value for key, value in given.items()}
        return tuple(values.get(name) for name in schemas.RAW_SALES.names)

    def build(*lines):
        return spark.createDataFrame([line(**given) for given in lines], schemas.RAW_SALES)

    return build


def test_ingest_rounds_parses_and_drops(spark, raw):
    titles = spark.createDataFrame([("9780001112223", "found")], schemas.TITLE_LOOKUP)
    rows = raw(
        {"Net_Sold_Units": 0.5}, {"Net_Sold_Units": 1.5}, {"Net_Sold_Units": 2.5},
        {"Date": "01/05/2001", "Title": None, "Net_Invc": None, "Headquarter": "\t n "},
        {"Date": "garbage"}, {"Title": None, "EAN": "short"}, {"SL_Class_of_Trade": "a"},
    )
    found = {r["TITLE"]: r for r in tl.ingest_month(rows, titles).collect()}
    assert set(found) == {"t", "found"}
    assert found["t"]["NETUNITS"] == 0 + 2 + 2 + 1 and float(found["t"]["NETAMT"]) == 4
    assert found["t"]["SL Class of Trade"] == "a"
    assert found["found"]["NAMECUST"] == "n" and found["found"]["NETAMT"] == 0
    assert (found["t"]["YEAR"], found["t"]["MONTH"]) == (2001, 1)
    cleaned = ingest.clean_rows(rows, titles)
    report = {r["CHECK_NAME"]: r["VALUE"] for r in tl.ingest_checks(cleaned).collect()}
    assert report["N_ROWS"] == 7 and report["DROPPED_ROWS"] == 2
    assert report["INVALID_ISBN_ROWS"] == 1 and report["DROPPED_AMOUNT"] == 2
    balance = checks.control_totals(cleaned, ingest.group_rows(cleaned), ["NETAMT"]).first()
    assert balance["DIFFERENCE"] == -report["DROPPED_AMOUNT"]


def test_history_repairs_keys_before_the_title_lookup(spark, raw):
    titles = spark.createDataFrame([("9780001112223", "found")], schemas.TITLE_LOOKUP)
    rows = raw({"EAN": "9780001112223.0", "Title": None}, {"EAN": None})
    (row,) = tl.reload_history(rows, titles).collect()
    assert (row["ISBN"], row["TITLE"]) == ("9780001112223", "found")


def test_unmapped_accounts(spark, raw):
    categories = spark.createDataFrame(
        [("001", "01", "c"), ("002", "01", None)], schemas.CATEGORY_MAP_A
    )
    rows = raw({}, {"SL_Account_Number": "002"}, {"SL_Account_Number": None})
    found = {tuple(r) for r in ingest.unmapped_accounts(rows, categories).collect()}
    assert found == {("002", "01", 1), (None, "01", 1)}


def test_channels(spark):
    stored = spark.createDataFrame(
        [("1", "t", "old name", "Y", "01", "001", 5, 2.0, "k", 2001, 7),
         ("1", "t", "n", "Y", "01", "009", 5, 2.0, "k", 1997, 7)],
        "ISBN string, TITLE string, NAMECUST string, `IPS Sale` string, `HQ Account Number` string,"
        " `SL Account Number` string, NETUNITS bigint, NETAMT double, `SL Class of Trade` string,"
        " YEAR int, MONTH int",
    )
    maps = spark.createDataFrame([("001", "01", "c")], schemas.CATEGORY_MAP_A)
    names = spark.createDataFrame([("old name", "new name")], schemas.NAME_MAP)
    (row,) = channels.channel_a(stored, maps, names, AS_OF).collect()
    assert (row["NAMECUST"], row["SALES_CATEGORY"], row["HQ_NUMBER"]) == ("new name", "c", "01")


def test_observed_totals(spark, facts, tmp_path):
    df = facts(("1", "t", "n", "c", 200107, 10, 5), ("2", "t", "n", "c", 200107, 3, 1))
    watched, seen = checks.observe_totals(df, "load", ["NETUNITS", "NETAMT"])
    watched.write.parquet(str(tmp_path / "out"))
    assert seen.get["N_ROWS"] == 2 and seen.get["NETUNITS"] == 13 and seen.get["NETAMT"] == 6
