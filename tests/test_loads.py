"""Loads, published tables, sums by load, and lines set aside."""

from __future__ import annotations

import os
import re
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators import checks, lookups
from tallyloom.plans import channels, combined, daily, ingest, monthly, targets
from tallyloom.sources import files, loads, published, readers, schemas, session, sinks
from workload import relations as rel
from workload.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"
AS_OF = date(2001, 8, 15)


@pytest.fixture
def month(spark):
    def build(*rows):
        """(ISBN, YEAR, MONTH, units)"""
        return spark.createDataFrame(
            [(i, "t", "n", "Y", "1", "2", u, None, "k", y, m) for i, y, m, u in rows],
            schemas.STORED_SALES,
        )

    return build


def units(spark, path, **options):
    rows = loads.read_loads(spark, path, **options).collect()
    return sorted((r["ISBN"], r["YEAR"], r["MONTH"], r["NETUNITS"]) for r in rows)


def test_same_rows_under_another_name_are_refused(spark, month, tmp_path):
    path = str(tmp_path / "fact")
    rows = [("1", 2001, 5, 10), ("2", 2001, 6, 3), ("2", 2001, 6, 3)]
    first = loads.write_load(month(*rows), path, "may")
    assert loads.write_load(month(*reversed(rows)).repartition(3), path, "may") == first
    with pytest.raises(loads.RepeatedLoad, match="may"):
        loads.write_load(month(*rows), path, "june")
    assert loads.write_load(month(*rows[:2]), path, "june").number == 2
    assert len(files.names_in(spark, f"{path}/data")) == 2
    assert units(spark, path) == sorted(rows + rows[:2])
    loads.write_load(month(("3", 2001, 5, 1)), path, "may")
    assert loads.write_load(month(*rows), path, "july").number == 4  # may has other rows now
    for name in ("none", "nothing"):
        assert loads.write_load(month(), path, name).rows == 0


def test_reads_as_of_a_load(spark, month, tmp_path):
    path = str(tmp_path / "fact")
    assert units(spark, path) == [] and loads.entries(spark, path) == []
    loads.replace_history(month(("1", 2001, 5, 10)), path)
    loads.write_load(month(("2", 2001, 6, 1)), path, "june")
    loads.write_load(month(("2", 2001, 6, 2)), path, "june")
    loads.replace_history(month(("9", 2001, 1, 9)), path)
    assert units(spark, path) == [("9", 2001, 1, 9)]
    assert units(spark, path, as_of=1) == [("1", 2001, 5, 10)]
    assert units(spark, path, as_of=2) == [("1", 2001, 5, 10), ("2", 2001, 6, 1)]
    assert units(spark, path, as_of=3) == [("1", 2001, 5, 10), ("2", 2001, 6, 2)]


def failing(df):
    """Rows of which the last ones fail once others are written."""
    return df.withColumn("v", F.when(F.col("id") > 900, F.raise_error(F.lit("no disk"))).otherwise(F.col("v")))


def test_a_write_that_fails_leaves_what_was_there(spark, month, tmp_path):
    table, fact = str(tmp_path / "table"), str(tmp_path / "fact")
    rows = spark.range(0, 1000, 1, 8).selectExpr("id", "id * 2 AS v")
    published.publish(rows, table)
    with pytest.raises(Exception, match="no disk"):
        published.publish(failing(rows), table)
    assert published.versions(spark, table) == [1]
    assert published.read_published(spark, table, rows.schema).count() == 1000

    loads.write_load(month(("1", 2001, 5, 10)), fact, "may")
    broken = month(*((str(i), 2001, 5, i) for i in range(50))).withColumn(
        "NETUNITS", F.when(F.col("NETUNITS") > 40, F.raise_error(F.lit("no disk"))).otherwise(F.col("NETUNITS"))
    )
    with pytest.raises(Exception, match="no disk"):
        loads.write_load(broken, fact, "may")
    assert units(spark, fact) == [("1", 2001, 5, 10)]
    left = len(files.names_in(spark, f"{fact}/data")) - 1
    assert loads.sweep(spark, fact) == [] and len(loads.sweep(spark, fact, hours=0)) == left
    assert len(files.names_in(spark, f"{fact}/data")) == 1 and units(spark, fact) == [("1", 2001, 5, 10)]


def test_writers_at_once_all_come_into_the_ledger(spark, month, tmp_path):
    """Six loads at the same time, two of them with the same rows."""
    path = str(tmp_path / "fact")

    def write(n):
        try:
            return loads.write_load(month((str(n // 2 * 2 if n > 3 else n), 2001, 5, 1)), path, f"load{n}").number
        except loads.RepeatedLoad:
            return None

    with ThreadPoolExecutor(6) as pool:
        numbers = list(pool.map(write, range(6)))
    taken = sorted(n for n in numbers if n)
    assert taken == [1, 2, 3, 4, 5] and numbers.count(None) == 1
    assert len(units(spark, path)) == 5


def test_versions_of_a_table(spark, tmp_path):
    table = str(tmp_path / "table")
    rows = spark.range(10)
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, table, rows.schema)
    for n in (10, 5, 1):
        published.publish(rows.limit(n), table)
    counts = [published.read_published(spark, table, rows.schema, v).count() for v in (1, 2, 3, None)]
    assert counts == [10, 5, 1, 1]
    assert published.drop_versions(spark, table, keep=1) == [1, 2]
    assert published.read_published(spark, table, rows.schema).count() == 1
    assert len(files.names_in(spark, table)) == 2
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, table, rows.schema, 1)


def test_a_number_is_given_once(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    assert files.create_once(spark, folder, "1", "a") and not files.create_once(spark, folder, "1", "b")
    assert files.read_text(spark, f"{folder}/1") == "a" and files.names_in(spark, folder) == ["1"]


def test_only_new_loads_are_read(spark, tmp_path):
    """One scan of a fact for its first sums, one load's files afterwards; sums as from all sales."""
    fact, sums = str(tmp_path / "fact"), str(tmp_path / "sums")
    stored = rel.stored_sales_a(spark, SF_DIR).select(*schemas.STORED_SALES.names)
    stored = sinks.written(stored, "sales")
    first = loads.replace_history(stored.filter("YEAR < 2001"), fact)
    assert monthly.keep_sums(spark, fact, sums, monthly.SHAPE_A) == [first.load_id]
    assert monthly.keep_sums(spark, fact, sums, monthly.SHAPE_A) == []
    second = loads.write_load(stored.filter("YEAR >= 2001"), fact, "2001")
    load = loads.read_loads(spark, fact, load_ids=[second.load_id])
    assert all(second.load_id in name for name in load.select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
    assert monthly.keep_sums(spark, fact, sums, monthly.SHAPE_A) == [second.load_id]
    kept = monthly.read_sums(spark, fact, sums, monthly.SHAPE_A)
    whole = monthly.monthly_sums(stored, monthly.SHAPE_A)
    assert kept.count() == whole.count() and kept.exceptAll(whole).isEmpty()
    assert monthly.read_sums(spark, fact, sums, monthly.SHAPE_A, as_of=1).filter("YEAR >= 2001").isEmpty()


def test_reports_from_sums_are_those_from_sales(spark):
    """Odd names, hyphens, cut amounts and unmapped accounts; lookups meet accounts."""
    sales = [
        ("978-1", "t", " n1 ", "Y", "h", "s", 5, 1.9, None, 2001, 7),
        ("9781", "t", "n1", "N", "h", "s", 5, 1.9, "k", 2001, 7),
        ("9781", "t", "n2", "N", "h", "s", 1, -1.9, "k", 2001, 6),
        ("9781", None, None, "N", None, "s", 2, 3.5, "k", 2001, 7),
        ("1", "u", "n3", "N", "h9", "s9", 7, 10.0, "k", 2000, 12),
    ]
    names = ", ".join(f"`{f.name}` {'double' if f.name == 'NETAMT' else f.dataType.simpleString()}" for f in schemas.STORED_SALES)
    stored = spark.createDataFrame(sales, names)
    categories = spark.createDataFrame([("s", "h", "c1")], schemas.CATEGORY_MAP_A)
    mapped = spark.createDataFrame([("n1", "N"), ("n2", "N")], schemas.NAME_MAP)
    direct = spark.createDataFrame([], schemas.SALES_S)
    sums = channels.channel_a(stored, categories, mapped, AS_OF)
    found = {(r["ISBN"], r["TITLE"], r["NAMECUST"], r["SALES_CATEGORY"]): r["12M_UNITS"]
             for r in combined.report_combined(sums, direct, None, rel.products(spark, SF_DIR), AS_OF).collect()}
    assert found == {("9781", "t", "N", "c1"): 11, ("9781", None, None, None): 2, ("1", "u", "n3", None): 7}
    actual = targets.facts_of(sums, direct).groupBy("NAMECUST").agg(F.sum("NETAMT").alias("a"), F.sum("SIZE").alias("z"))
    assert {r["NAMECUST"]: (r["a"], r["z"]) for r in actual.collect()} == {"N": (1, 3), None: (3, 3), "n3": (10, 10)}
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "MASTER SALES CATEGORY" not in plan  # looked up where accounts were stored


def test_maps_meet_accounts_only(spark, monkeypatch):
    seen = []

    def counting(df, *args, **options):
        seen.append((df.count(), options.get("unique", False)))
        return lookup(df, *args, **options)

    lookup = lookups.lookup
    for module in (channels, lookups):
        monkeypatch.setattr(module, "lookup", counting)
    monkeypatch.setattr("tallyloom.plans.distributor.lookup", counting)
    stored = rel.stored_sales_a(spark, SF_DIR)
    accounts = stored.select("HQ Account Number", "SL Account Number", "NAMECUST").distinct().count()
    channels.channel_a(stored, rel.category_map_a(spark, SF_DIR), rel.name_map(spark, SF_DIR), AS_OF)
    assert [n for n, of_accounts in seen if not of_accounts] == [accounts, accounts]


def test_refresh_returns_what_its_writes_saw(spark, tmp_path):
    maps = {"CATEGORY_MAP_A": rel.category_map_a, "CATEGORY_MAP_S": rel.category_map_s, "NAME_MAP": rel.name_map}
    found = daily.daily_refresh(
        spark, rel.stored_sales_a(spark, SF_DIR), rel.stored_sales_s(spark, SF_DIR),
        {name: build(spark, SF_DIR) for name, build in maps.items()}, rel.targets(spark, SF_DIR),
        rel.products(spark, SF_DIR), rel.locations(spark, SF_DIR), str(tmp_path), AS_OF, 2001,
    )
    for name, stored in found.items():
        report = spark.read.parquet(stored.path)
        assert stored.totals["N_ROWS"] == report.count()
        for column in daily.TOTALS[name]:
            assert float(stored.totals[column]) == pytest.approx(report.agg(F.sum(column)).first()[0])


LINES = """EAN,Open Backorder,Title,Note
007,3,t,x
008,many,"a, b",x
009,4
010,5,"two
lines",x
,,,
011,6,u,x,y
"""


def test_unreadable_lines_are_set_aside(spark, tmp_path):
    path = tmp_path / "backorders.csv"
    path.write_text(LINES)
    rows, aside = readers.read_or_set_aside(spark, str(path), schemas.RAW_BACKORDERS, multiLine="true")
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted(
        [("007", "t", 3), ("010", "two\nlines", 5), (None, None, None)], key=repr
    )
    found = {(r["REASON"], r["LINE"]) for r in aside.collect()}
    assert found == {
        ("Open Backorder", '008,many,"a, b",x'), ("number of fields", "009,4"), ("number of fields", "011,6,u,x,y")
    }
    assert all(r["FILE"].endswith("backorders.csv") for r in aside.collect())
    rows, aside = readers.read_or_set_aside(
        spark, str(path), schemas.RAW_BACKORDERS, optional=["Title"], multiLine="true"
    )
    assert (rows.count(), aside.count()) == (3, 3)
    checked = ingest.ingest_checks(
        rows.selectExpr("EAN AS ISBN", "Title AS TITLE", "1 AS YEAR", "1 AS MONTH", "Title AS NAMECUST",
                        "EAN AS `IPS Sale`", "EAN AS `HQ Account Number`", "EAN AS `SL Account Number`",
                        "1L AS NETUNITS", "1.0 AS NETAMT"), aside)
    values = {r["CHECK_NAME"]: int(r["VALUE"]) for r in checked.collect()}
    assert (values["N_ROWS"], values["DROPPED_ROWS"], values["UNREADABLE_LINES"]) == (3, 1, 3)


def test_samples_are_one_pass(spark):
    rows = spark.range(400).selectExpr("id AS k", "id % 7 - 3 AS u", "if(id = 5, null, 1.5 - id) AS d")
    found = checks.sign_samples(rows, ["u", "d"], ["k"], 2)
    assert sorted((r["MEASURE"], r["SIGN"], r["k"]) for r in found.collect()) == [
        ("d", "NEGATIVE", 2), ("d", "NEGATIVE", 3), ("d", "POSITIVE", 0), ("d", "POSITIVE", 1),
        ("u", "NEGATIVE", 0), ("u", "NEGATIVE", 1), ("u", "POSITIVE", 4), ("u", "POSITIVE", 5),
    ]
    found = checks.sign_samples(rows, ["u", "d"], ["k"], 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")


def test_few_products_pass_over_row_groups(spark, month, tmp_path):
    conf, path = spark._jsc.hadoopConfiguration(), str(tmp_path / "fact")
    conf.set("parquet.block.size", "20000")
    try:
        loads.replace_history(month(*((f"{i % 2000:05d}", 2001, 5, i) for i in range(20_000))).repartition(4), path)
    finally:
        conf.unset("parquet.block.size")
    wanted = spark.createDataFrame([("00007",), ("01234",), (None,), ("99999",)], "ISBN string")
    few = lookups.restrict_to_few(loads.read_loads(spark, path), wanted, "ISBN")
    assert few.count() == 20 and sum(r["NETUNITS"] for r in few.collect()) == sum(
        i for i in range(20_000) if i % 2000 in (7, 1234)
    )
    scanned = few.select("NETUNITS")
    scanned.collect()
    plan = scanned._jdf.queryExecution().executedPlan()
    scan = next(iter(re.findall("In\\(ISBN, .*?\\)", plan.toString())), None)
    node = plan
    while node.children().size():
        node = node.children().apply(0)
    assert scan and node.metrics().apply("numOutputRows").value() < 8000
    more = lookups.restrict_to_few(loads.read_loads(spark, path), wanted, "ISBN", most=1)
    assert more.count() == 20
    assert lookups.restrict_to_few(few, wanted.limit(0), "ISBN").count() == 0


def test_digest_is_that_of_decimal_sums(spark):
    """Of many tasks, copies and nulls; a ledger's older entries stay comparable."""
    rows = spark.range(0, 3000, 1, 7).selectExpr("id % 900 AS i", "if(id % 5 = 0, null, concat('t', id % 11)) AS t")
    parts = [part for name in ("i", "t") for part in (F.col(name).isNull(), F.col(name))]
    sums = rows.agg(*(F.sum(F.xxhash64(F.lit(seed), *parts).cast("decimal(38,0)")) for seed in "ab")).first()
    assert loads.content_digest(rows) == (f"3000:{sums[0]}:{sums[1]}", 3000)
    assert loads.content_digest(rows.limit(0)) == ("0:0:0", 0)


def test_only_lines_set_aside_are_put_together_again(spark, tmp_path, monkeypatch):
    (tmp_path / "raw.csv").write_text("EAN,Net Invc\n1,2.5\n2,n/a\n3\n4,1,9\n")
    stored = []
    monkeypatch.setattr(readers, "written", lambda df, purpose: stored.append(df) or sinks.written(df, purpose))
    schema = T.StructType([T.StructField("EAN", T.StringType()), T.StructField("Net Invc", T.DoubleType())])
    rows, set_aside = readers.read_or_set_aside(spark, str(tmp_path / "raw.csv"), schema)
    plan = stored[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("to_csv(") == 1
    assert [tuple(r) for r in rows.collect()] == [("1", 2.5)]
    found = {(r["LINE"], r["REASON"]) for r in set_aside.collect()}
    assert found == {("2,n/a", "Net Invc"), ("3", "number of fields"), ("4,1,9", "number of fields")}


def test_a_rerun_is_not_gathered_by_month(spark, month, tmp_path, monkeypatch):
    """Rows are compared as they come; only those that differ are moved to their months."""
    path, moved, by_month = str(tmp_path / "fact"), [], loads._by_month
    monkeypatch.setattr(loads, "_by_month", lambda df: moved.append(df.count()) or by_month(df))
    monkeypatch.setattr(sinks, "shared_folder", lambda spark, purpose: str(tmp_path / purpose))
    may, june = [("1", 2001, 5, 10), ("2", 2001, 6, 3), ("2", 2001, 6, 3)], [("3", 2001, 6, 1)]
    first = loads.write_load(month(*may), path, "may")
    assert loads.write_load(month(*reversed(may)).repartition(3), path, "may") == first and moved == [3]
    loads.write_load(month(*june), path, "june")
    with pytest.raises(loads.RepeatedLoad, match="may"):
        loads.write_load(month(*may), path, "june")
    assert moved == [3, 1] and units(spark, path) == sorted(may + june)
    corrected = loads.write_load(month(*may[:2]), path, "may")
    assert corrected.number == 3 and moved == [3, 1, 2] and units(spark, path) == sorted(may[:2] + june)
    assert loads.write_load(month(), path, "may").rows == 0 and units(spark, path) == june
    assert loads.write_load(month(), path, "may").number == 5
    loads.replace_history(month(*may), path)
    assert loads.replace_history(month(*may), path).number == 7 and units(spark, path) == sorted(may)
    assert not (tmp_path / "rerun").exists()


def shuffle_files(spark):
    """How many lie on the disks of a local session."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(found.apply(i).getName().startswith("shuffle_") for i in range(found.size()))


def test_rerun_safe_puts_sales_together_once_and_leaves_no_shuffles(spark, tmp_path, monkeypatch):
    scans, table, left = [], rel.table, []
    monkeypatch.setattr(rel, "table", lambda *args: scans.append(args[2]) or table(*args))
    remove = sinks.remove
    monkeypatch.setattr(sinks, "remove", lambda spark, path: left.append(path) or remove(spark, path))
    spark._jvm.System.gc()
    time.sleep(1)
    before, setting = shuffle_files(spark), spark.conf.get(session.CLEANUP, None)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        totals = QUERIES["ingest_rerun_safe"](spark, SF_DIR)
        bound = time.time() + 10
        # lookups and digests, which aren't written, leave a few small ones
        while shuffle_files(spark) > before + 60 and time.time() < bound:
            time.sleep(0.2)
        assert shuffle_files(spark) <= before + 60
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert scans.count("lineitem") == scans.count("orders") == 1
    assert spark.conf.get(session.CLEANUP, None) == setting
    assert len(left) == 3 and not any(os.path.exists(path.removeprefix("file://")) for path in left)
    assert totals.count() == 80


def test_filters_for_products_are_as_small_as_files(spark, month, tmp_path):
    path = tmp_path / "fact"
    loads.replace_history(month(*((f"{i:013d}", 2001, 1 + i % 6, i) for i in range(3000))), str(path))
    sizes = [file.stat().st_size for file in path.rglob("*.parquet")]
    assert len(sizes) >= 6 and max(sizes) < 200_000


def test_the_setting_goes_back_when_the_last_block_ends(spark):
    before = spark.conf.get(session.CLEANUP, None)
    with session.shuffles_go(spark):
        with pytest.raises(ZeroDivisionError), session.shuffles_go(spark):
            1 / 0
        assert spark.conf.get(session.CLEANUP) == "true"
    assert spark.conf.get(session.CLEANUP, None) == before
