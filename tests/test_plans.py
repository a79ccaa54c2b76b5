"""The plans behind the results: what is scanned, shuffled and broadcast."""

from __future__ import annotations

import re

import pytest

from tallyloom.operators import matrix
from tallyloom.plans import distributor
from tallyloom.plans.combined import KEYS, buckets
from workload import relations as rel
from workload.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"
WRITERS = {
    "ingest_file", "ingest_file_by_name", "ingest_rerun_safe", "history_file", "backorder_file",
    "target_file", "daily_refresh", "daily_combined", "daily_targets", "reference_map",
    "name_map_file", "stored_distributor", "stored_titles", "loads_combined", "loads_replayed",
    "loads_repeated", "published_version", "ingest_unreadable", "unreadable_lines",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_matrix_has_one_shuffle_and_partial_sums(spark):
    sales = rel.both_channels(spark, SF_DIR, rel.AS_OF)
    plan = plan_of(matrix.period_matrix(sales, KEYS, buckets(rel.AS_OF), rel.AS_OF))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert plan.count("HashAggregate") == 2 and "partial_sum" in plan
    assert "SortAggregate" not in plan


def test_look_back_reaches_the_scan(spark):
    plan = plan_of(QUERIES["report_targets"](spark, SF_DIR))
    scans = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    bounded = [s for s in scans if "GreaterThanOrEqual(o_orderdate" in s and "LessThan(o_orderdate" in s]
    assert len(bounded) == 2


def test_coarse_totals_read_the_stored_matrix(spark):
    """The sales are read when the matrix is stored, not again by what joins to it."""
    for name in ("report_combined", "report_distributor", "coarse_totals"):
        plan = plan_of(QUERIES[name](spark, SF_DIR))
        assert "l_orderkey" not in plan and "12M_UNITS" in plan


def test_ingest_sorts_no_sales(spark):
    """The minimum of a text is taken over rows that a hash aggregate has made."""
    plan = plan_of(QUERIES["ingest_month"](spark, SF_DIR))
    assert plan.index("HashAggregate") > plan.index("SortAggregate")
    assert plan.count("SortAggregate(key=[ISBN") == 2


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(QUERIES["months_12"](spark, SF_DIR))
    (schema,) = re.findall(r"ReadSchema: struct<(l_orderkey[^>]*)>", plan)
    assert set(re.findall(r"(\w+):", schema)) == {
        "l_orderkey", "l_partkey", "l_quantity", "l_returnflag",
    }


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in plan


def test_a_refresh_reads_the_sales_once(spark, monkeypatch):
    """Both reports come from one scan; only the stored rollup stands for another."""
    scans, table = [], rel.table
    monkeypatch.setattr(rel, "table", lambda *args: scans.append(args[2]) or table(*args))
    QUERIES["daily_refresh"](spark, SF_DIR).collect()
    assert scans.count("lineitem") == 1
    scans.clear()
    QUERIES["loads_replayed"](spark, SF_DIR).collect()
    assert scans.count("lineitem") == 2 and scans.count("orders") == 2


def test_lines_are_not_moved_to_meet_customers(spark):
    """Orders meet customers before lines do."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        plan = rel.sales(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    assert "l_orderkey" not in plan[plan.index("hashpartitioning(o_custkey") : plan.index("hashpartitioning(c_custkey")]


def test_dimensions_are_met_by_accounts(spark, monkeypatch):
    seen = []
    add = distributor.add_category
    monkeypatch.setattr(distributor, "add_category", lambda df, table: seen.append(df.columns) or add(df, table))
    QUERIES["dimensions_past_nulls"](spark, SF_DIR)
    assert seen == [["NAMECUST", "SL Account Number", "HQ Account Number"]]
