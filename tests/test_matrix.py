from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import matrix
from tallyloom.operators.cleaning import look_back
from tallyloom.plans.combined import KEYS, buckets
from workload import relations as rel

SF_DIR = "/root/testdata/sf0.001"
AS_OF = rel.AS_OF


def _one(df):
    return {row[df.columns[0]]: row.asDict() for row in df.collect()}


def test_null_keys_keep_and_zero(facts):
    df = facts(("1", "t", "n", None, 200107, 10, 5), ("2", "t", "n", "c", 200107, 3, 1))
    cells = matrix.trailing(AS_OF, 12, {"NETUNITS": "U", "NETAMT": "D"})
    kept = _one(matrix.period_matrix(df, KEYS, cells, AS_OF))
    zero = _one(matrix.period_matrix(df, KEYS, cells, AS_OF, null_keys="zero"))
    assert kept["1"]["U"] == 10 and kept["1"]["D"] == 5
    assert zero["1"]["U"] == 0 and zero["1"]["D"] == 0
    assert kept["2"] == zero["2"]
    with pytest.raises(ValueError):
        matrix.period_matrix(df, KEYS, cells, AS_OF, null_keys="drop")


def test_keys_without_bucket_stay_and_later_months_do_not(facts):
    df = facts(
        ("old", "t", "n", "c", 199503, 7, 7),
        ("now", "t", "n", "c", 200108, 7, 7),
        ("later", "t", "n", "c", 200109, 7, 7),
    )
    rows = _one(matrix.period_matrix(df, KEYS, buckets(AS_OF), AS_OF))
    assert set(rows) == {"old"}
    assert rows["old"]["12M_UNITS"] == 0 and rows["old"]["YTD_DOLLARS"] == 0


def test_january(facts):
    df = facts(("1", "t", "n", "c", 200012, 4, 9), ("1", "t", "n", "c", 200101, 1, 1))
    rows = _one(matrix.period_matrix(df, KEYS, buckets(date(2001, 1, 10)), date(2001, 1, 10)))
    assert rows["1"]["YTD_UNITS"] == 0 and rows["1"]["YTD_DOLLARS"] == 0
    assert rows["1"]["NET_UNITS_Dec_2000"] == 4
    assert rows["1"]["UNITS_2000"] == 4


def test_only_empty_buckets(facts):
    df = facts(("1", "t", "n", "c", 200012, 4, 9))
    day = date(2001, 1, 10)
    cells = matrix.ytd(day, {"NETUNITS": "U", "NETAMT": "D"})
    df = matrix.period_matrix(df, KEYS, cells, day, smallest={"CLASS": "TITLE"})
    assert [tuple(r) for r in df.collect()] == [("1", "t", "n", "c", 0, 0, "t")]


def test_months_add_up_and_nothing_is_lost(spark):
    df = rel.both_channels(spark, SF_DIR)
    cells = buckets(AS_OF)
    report = matrix.period_matrix(df, KEYS, cells, AS_OF)
    months = [c.name for c in cells if c.name.startswith("NET_UNITS_")]
    assert len(months) == 12
    bad = report.filter(sum(F.col(m) for m in months) != F.col("`12M_UNITS`"))
    assert bad.isEmpty()
    window = df.filter("YEAR * 100 + MONTH between 200008 and 200107")
    expected = window.agg(F.sum("NETUNITS"), F.sum("NETAMT")).first()
    found = report.agg(F.sum("`12M_UNITS`"), F.sum("`12M_DOLLARS`")).first()
    assert tuple(found) == tuple(expected)


@pytest.mark.parametrize("month", range(1, 13))
def test_equals_the_literal_join_chain(spark, month):
    """One filtered aggregate per bucket, joined to the keys, for every month of a year."""
    day = date(2000, month, 15)
    df = look_back(rel.both_channels(spark, SF_DIR), day).select(*KEYS, "YEAR", "MONTH", "NETUNITS")
    df = df.cache()
    cells = [c for c in buckets(day) if c.measure == "NETUNITS"][:6] + [
        c for c in buckets(day) if c.name.startswith("UNITS_")
    ]
    found = matrix.period_matrix(df, KEYS, cells, day, null_keys="zero")
    chain = df.select(*KEYS).distinct()
    for cell in cells:
        part = (
            df.filter((F.expr("YEAR*100+MONTH") >= cell.first) & (F.expr("YEAR*100+MONTH") <= cell.last))
            .groupBy(*KEYS)
            .agg(F.sum("NETUNITS").alias(cell.name))
        )
        chain = chain.join(part, KEYS, "left")
    chain = chain.fillna(0)
    assert sorted(map(str, found.collect())) == sorted(map(str, chain.collect()))
    df.unpersist()


def test_row_order_changes_nothing(spark):
    df = rel.stored_sales_a(spark, SF_DIR)
    def run(rows):
        return sorted(
            map(
                str,
                matrix.period_matrix(
                    rows,
                    ["ISBN", "NAMECUST"],
                    matrix.trailing(AS_OF, 12, {"NETAMT": "D"}),
                    AS_OF,
                    carry={"CLASS": F.min("SL Class of Trade")},
                ).collect(),
            )
        )
    assert run(df) == run(df.repartition(7, "NETUNITS").sortWithinPartitions(F.desc("NETAMT")))


def test_coarse_totals_count_only_the_window(facts):
    df = facts(
        ("1", "t", "a", "c", 200107, 1, 1),
        ("1", "t", "b", "c", 200008, 2, 2),
        ("1", "t", "b", None, 200008, 16, 2),
        ("1", "t", "b", "c", 200007, 4, 4),
        ("1", "t", "b", "c", 200108, 8, 8),
    )
    rows = matrix.period_matrix(df, KEYS, matrix.trailing(AS_OF, 12, {"NETUNITS": "U"}), AS_OF)
    assert matrix.coarse_totals(rows, ["ISBN"], {"U": "ALL"}).first()["ALL"] == 19
