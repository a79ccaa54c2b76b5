from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tallyloom.sources import loads, published, readers, schemas, session, sinks
from workload import relations as rel

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def month(spark):
    def build(*rows):
        """(ISBN, YEAR, MONTH, units)"""
        return spark.createDataFrame(
            [(i, "t", "n", "Y", "1", "2", u, None, "k", y, m) for i, y, m, u in rows],
            schemas.STORED_SALES,
        )

    return build


def units(spark, path):
    return {(r["YEAR"], r["MONTH"]): r["NETUNITS"] for r in
            loads.read_loads(spark, path).groupBy("YEAR", "MONTH")
            .agg(F.sum("NETUNITS").alias("NETUNITS")).collect()}


def test_rerun_replaces_only_its_own_load(spark, month, tmp_path):
    path = str(tmp_path / "fact")
    loads.replace_history(month(("1", 2001, 5, 10), ("2", 2001, 6, 20)), path)
    july = month(("1", 2001, 7, 7), ("9", 2001, 6, 1))
    for _ in range(2):
        loads.write_load(july, path, "2001-07")
        assert units(spark, path) == {(2001, 5): 10, (2001, 6): 21, (2001, 7): 7}
    loads.write_load(month(("1", 2001, 7, 8)), path, "2001-07")
    assert units(spark, path) == {(2001, 5): 10, (2001, 6): 20, (2001, 7): 8}
    loads.replace_history(month(("1", 2001, 5, 1)), path)
    assert units(spark, path) == {(2001, 5): 1}
    with pytest.raises(ValueError):
        loads.write_load(july, path, "../x")


def test_period_filter_prunes_directories(spark, month, tmp_path):
    path = str(tmp_path / "fact")
    loads.replace_history(month(*((str(m), 2001, m, 1) for m in range(1, 13))), path)
    pruned = loads.read_loads(spark, path).filter("YEAR = 2001 and YEAR * 100 + MONTH <= 200103")
    assert pruned.select("ISBN").distinct().count() == 3
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    (filters,) = re.findall(r"PartitionFilters: \[(.*)\], PushedFilters", plan)
    assert re.search(r"YEAR#\d+ = 2001", filters) and re.search(r"MONTH#\d+ \+ 200100\) <= 200103", filters)


def test_rows_of_a_month_go_to_few_files(spark, tmp_path):
    path = str(tmp_path / "fact")
    stored = rel.stored_sales_a(spark, SF_DIR).select(*schemas.STORED_SALES.names)
    loads.replace_history(stored.repartition(8), path)
    files = loads.read_loads(spark, path).select(F.input_file_name().alias("f"), "YEAR", "MONTH")
    per_month = files.groupBy("YEAR", "MONTH").agg(F.count_distinct("f").alias("n"))
    assert per_month.agg(F.max("n")).first()[0] <= 2


def test_empty_map_does_not_replace(spark, tmp_path):
    path = str(tmp_path / "map")
    full = spark.createDataFrame([("a", "b")], schemas.NAME_MAP)
    assert sinks.replace_if_any(full, path)
    assert not sinks.replace_if_any(full.limit(0), path)
    assert published.read_published(spark, path, schemas.NAME_MAP).count() == 1


def test_block_ends_at_first_blank(spark, tmp_path):
    path = tmp_path / "map.csv"
    path.write_text("SOURCE_NAME,TARGET_NAME\na,A\nb,\n , C\nd,D\n")
    rows = readers.read_block(spark, str(path), schemas.NAME_MAP).collect()
    assert [tuple(r) for r in rows] == [("a", "A"), ("b", None)]
    whole = tmp_path / "whole.csv"
    whole.write_text("SOURCE_NAME,TARGET_NAME\n" + "".join(f"n{i},N\n" for i in range(500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert readers.read_block(spark, str(whole), schemas.NAME_MAP).count() == 500
        whole.write_text(whole.read_text() + ",x\n" + "".join(f"m{i},N\n" for i in range(500)))
        split = readers.read_block(spark, str(whole), schemas.NAME_MAP)
        assert split.rdd.getNumPartitions() > 1
        assert split.filter("SOURCE_NAME like 'n%'").count() == split.count() == 500
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    with pytest.raises(ValueError):
        readers.read_block(spark, str(path), schemas.targets_schema(2025))


def test_wrong_header_fails(spark, tmp_path):
    path = tmp_path / "backorders.csv"
    path.write_text("EAN,Titel,Open Backorder\n007,t,3\n")
    with pytest.raises(Exception, match="header"):
        readers.read_file(spark, str(path), schemas.RAW_BACKORDERS).collect()
    path.write_text("EAN,Title,Open Backorder\n007,t,3\n")
    assert tuple(readers.read_file(spark, str(path), schemas.RAW_BACKORDERS).first()) == ("007", "t", 3)


def test_jdbc_reads_a_connection_per_month():
    months = readers.jdbc_predicates(1998, 2001)
    assert len(months) == 48 and months[0] == "YEAR = 1998 AND MONTH = 1"


def test_columns_go_by_name(spark, tmp_path):
    path = tmp_path / "backorders.csv"
    path.write_text("Note,Open Backorder,EAN,Title\nx,3,007,t\n")
    read = readers.read_by_name(spark, str(path), schemas.RAW_BACKORDERS)
    assert [tuple(r) for r in read.collect()] == [("007", "t", 3)]
    path.write_text("Open Backorder,EAN\n3,007\n")
    with pytest.raises(ValueError, match="Title"):
        readers.read_by_name(spark, str(path), schemas.RAW_BACKORDERS)
    read = readers.read_by_name(spark, str(path), schemas.RAW_BACKORDERS, optional=["Title"])
    assert [tuple(r) for r in read.collect()] == [("007", None, 3)]


def test_target_columns_follow_the_year():
    assert "2027" in schemas.targets_schema(2027).names
    assert "2026" in schemas.targets_optional(2027)


@pytest.mark.parametrize("padding", [0, 50])
def test_each_file_is_cut_by_itself(spark, tmp_path, padding):
    head = "SOURCE_NAME,TARGET_NAME\n"
    (tmp_path / "1.csv").write_text(head + "a,A\n,\nb,B\n")
    (tmp_path / "2.csv").write_text(head + f"d,{'D' * (1 + padding)}\ne,E\n")
    read = readers.read_block(spark, str(tmp_path), schemas.NAME_MAP)
    assert {r["SOURCE_NAME"] for r in read.collect()} == {"a", "d", "e"}


def test_shared_folder_is_taken_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = (session.shared_folder(spark, "x") for _ in range(2))
    assert first.startswith(root) and first != second
