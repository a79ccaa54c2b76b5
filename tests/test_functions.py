from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.functions import numbers, text
from tallyloom.operators import cleaning
from tallyloom.sources import schemas


def values(spark, rows, kind, expression):
    df = spark.createDataFrame([(r,) for r in rows], f"v {kind}")
    return [r[0] for r in df.select(expression(F.col("v"))).collect()]


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(alphabet=" \t\n  aé*-", max_size=6), min_size=1, max_size=30))
def test_strip_is_pythons_strip(spark, rows):
    assert values(spark, rows, "string", text.strip) == [row.strip() for row in rows]


def test_hyphens_and_marks(spark):
    assert values(spark, ["978-0-00-1", None], "string", text.strip_hyphens) == ["9780001", None]
    assert values(spark, ["N*", "*N*"], "string", text.strip_name_mark) == ["N", "N"]
    assert values(spark, ["N", None], "string", text.mark_shared) == ["N~", None]


def test_isbn_repair(spark):
    rows = ["9780001112223.0", "9.78E+12", "9.78e+12", "1.0.5", None]
    assert values(spark, rows, "string", text.repair_isbn) == [
        "9780001112223",
        "97812",
        "97812",
        "15",
        None,
    ]
    assert values(spark, ["9780001112223", "1", None], "string", text.is_invalid_isbn) == [
        False,
        True,
        True,
    ]


def test_rounding_and_truncation(spark):
    rows = [0.5, 1.5, 2.5, -0.5, None]
    assert values(spark, rows, "double", numbers.round_half_even) == [0, 2, 2, 0, None]
    assert values(spark, [1.9, -1.9, 2.5], "double", numbers.whole) == [1, -1, 2]


def test_dates(spark):
    rows = ["garbage", "1/5/2025", "01/05/2025", "13/5/2025", None]
    wrong = ["2025-01-05", "1/5/25", "1/5/2025/7", "1/5/2025 10:00", "2/30/2025", "1//2025", "/"]
    months = values(spark, rows, "string", lambda c: F.month(numbers.raw_date(c)))
    assert months == [None, 1, 1, None, None]
    assert values(spark, wrong, "string", numbers.raw_date) == [None] * len(wrong)
    days = values(spark, ["2/29/2024", "12/31/1999"], "string", numbers.raw_date)
    assert [str(day) for day in days] == ["2024-02-29", "1999-12-31"]


def test_percent(spark):
    df = spark.createDataFrame([(0, 0), (1, 3), (5, 0)], "a bigint, t bigint")
    rows = df.select(numbers.percent(F.col("a"), F.col("t"))).collect()
    assert [r[0] for r in rows] == [None, 33.3, None]


def test_conform(spark):
    df = spark.createDataFrame(
        [("x", " 007\t", "2001", "7", "t", "n", "5", "1.25", "c")],
        "EXTRA string, ISBN string, YEAR string, MONTH string, TITLE string, NAMECUST string,"
        " NETUNITS string, NETAMT string, SALES_CATEGORY string",
    )
    row = cleaning.conform(df, schemas.SALES).first()
    assert row["ISBN"] == "007" and row["NETUNITS"] == 5 and float(row["NETAMT"]) == 1.25
    bad = df.withColumn("NETUNITS", F.lit("n/a"))
    assert cleaning.conform(bad, schemas.SALES, dirty=True).first()["NETUNITS"] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cleaning.conform(bad, schemas.SALES).collect()


def test_exclude_customer_keeps_nameless(spark):
    df = spark.createDataFrame([("BIG ONE",), ("B",), (None,)], "NAMECUST string")
    kept = cleaning.exclude_customer(df, "BIG%").collect()
    assert {r[0] for r in kept} == {"B", None}


def test_fills_and_order(spark):
    df = spark.createDataFrame([(None, None, 1.9)], "a int, b string, c double")
    filled = cleaning.fill_nulls(df, zero=["a"], empty=["b"]).first()
    assert tuple(filled) == (0, "", 1.9)
    assert tuple(cleaning.whole_numbers(df, keep=["x"]).first()) == (0, None, 1)
