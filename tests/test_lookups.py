from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import lookups


@pytest.fixture
def pair(spark):
    sales = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 3), ("z", 4), (None, 5)], "K string, V int"
    )
    table = spark.createDataFrame(
        [("a", "x", 2), ("a", "x", 1), ("b", None, 3), ("b", "y", 1), (None, "n", 0)],
        "KEY string, NAME string, N int",
    )
    return sales, table


EXPECTED = {("a", 1, "x", 1), ("a", 2, "x", 1), ("b", 3, "y", 1), ("z", 4, None, None)}


@pytest.mark.parametrize("options", [{}, {"limit": 0}, {"measured": False}])
def test_all_strategies_agree_and_add_no_rows(pair, options):
    sales, table = pair
    rows = lookups.lookup(sales, table, {"K": "KEY"}, **options).collect()
    assert {tuple(r) for r in rows} == EXPECTED | {(None, 5, None, None)}
    assert len(rows) == 5
    safe = lookups.lookup(sales, table, {"K": "KEY"}, null_safe=True, **options).collect()
    assert {tuple(r) for r in safe} == EXPECTED | {(None, 5, "n", 0)}


def test_first_by_key_takes_the_fullest_then_smallest(pair):
    _, table = pair
    rows = {tuple(r) for r in lookups.first_by_key(table, ["KEY"]).collect()}
    assert rows == {("a", "x", 1), ("b", "y", 1), (None, "n", 0)}
    assert lookups.first_by_key(table.select("KEY"), ["KEY"]).count() == 3


def test_duplicates_are_reported(pair):
    _, table = pair
    rows = {tuple(r) for r in lookups.duplicate_keys(table, ["KEY"]).collect()}
    assert rows == {("a", 1), ("b", 1)}


def test_missing_from_counts_null_keys(pair):
    sales, table = pair
    rows = {tuple(r) for r in lookups.missing_from(sales, table, {"K": "KEY"}).collect()}
    assert rows == {("z", 1), (None, 1)}


def test_size_is_measured(spark):
    table = spark.createDataFrame([("k" * 100, "ü" * 50)], "K string, V string")
    assert lookups.fits_broadcast(table, 232)
    assert not lookups.fits_broadcast(table, 231)
    assert lookups.fits_broadcast(table.limit(0), 0)


def test_hot_key_is_spread_over_tasks(spark):
    """A third of the rows share a key; above the limit no task gets them all."""
    sales = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("K"),
        F.col("id").alias("V"),
    )
    table = sales.select("K").distinct().withColumn("NAME", F.upper("K"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookups.lookup(sales, table, ["K"], unique=True, limit=0)
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
        placed = joined.filter("K = 'hot'").select(F.spark_partition_id().alias("P"))
        share = placed.groupBy("P").count().agg(F.max("count"), F.sum("count")).first()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert share[1] == 10_000
    assert share[0] < 6_000


def test_equal_rows_of_a_hot_key_are_spread(spark):
    """Rows that differ in nothing still go to all the places their key has."""
    rows = spark.range(200_000, numPartitions=64).select(
        F.lit("hot").alias("EAN"), F.lit(None).cast("string").alias("Title")
    )
    titles = spark.createDataFrame([("hot", "T"), ("cold", "U")], "Z string, L string")
    hot = lookups.hot_keys(rows, ["EAN"]).first()
    assert hot["_places"] == int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookups.lookup(rows, titles, {"EAN": "Z"}, limit=0)
        assert joined.filter("L = 'T'").count() == 200_000
        salted = joined.groupBy(F.spark_partition_id().alias("P")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(salted) >= 4 and max(r["count"] for r in salted) < 120_000


def test_runtime_splits_a_hot_key_of_an_unmeasured_table(spark):
    sales = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("K"),
        F.xxhash64("id").alias("V"),
    )
    table = sales.groupBy("K").agg(F.count("V").alias("TOTAL"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = lookups.lookup(sales, table, ["K"], unique=True, measured=False)
        checked = joined.agg(F.count("TOTAL"), F.sum(F.when(F.col("K") == "hot", 1)))
        assert [tuple(row) for row in checked.collect()] == [(200_000, 66_667)]
        plan = checked._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_fill_and_names(spark):
    rows = spark.createDataFrame([("1", None), ("1", "own"), ("2", None)], "I string, T string")
    titles = spark.createDataFrame([("1", "b"), ("1", "a")], "Z string, L string")
    filled = lookups.fill_from(rows, titles, {"I": "Z"}, "T", "L")
    assert sorted(map(tuple, filled.collect()), key=str) == [("1", "a"), ("1", "own"), ("2", None)]
    names = spark.createDataFrame([("own", "ours")], "SOURCE_NAME string, TARGET_NAME string")
    mapped = lookups.map_names(filled.select("T"), names, "T")
    assert {r["T"] for r in mapped.collect()} == {"a", "ours", None}


def test_restrict_to(pair):
    sales, table = pair
    kept = lookups.restrict_to(sales, table.withColumnRenamed("KEY", "K"), ["K"])
    assert {r["V"] for r in kept.collect()} == {1, 2, 3}


@pytest.mark.parametrize("keys", [["k"], ["k", "j"]])
def test_hashed_choice_is_the_sorted_one(spark, keys):
    """Nulls in keys and values, copies, ties and a key with most of the rows."""
    rng = random.Random(3)
    some = lambda *values: rng.choice([None, *values])
    rows = [
        (rng.choice(["hot"] * 5 + [None, "a", "b", str(n // 4)]), some("x", "y"), some("t1", "t2", "é"), some(1, 2), some(1.5))
        for n in range(3000)
    ]
    df = spark.createDataFrame(rows + rows[:50], "k string, j string, t string, n int, d double")
    whole, hashed = (f(df, keys) for f in (lookups.first_by_key, lookups.first_by_key_hashed))
    assert sorted(map(repr, hashed.collect())) == sorted(map(repr, whole.collect()))
    only_keys = df.select(*keys)
    assert lookups.first_by_key_hashed(only_keys, keys).count() == only_keys.distinct().count()


def test_big_tables_are_not_sorted_for_their_first_rows(spark):
    table = spark.range(5000).selectExpr("concat('k', id % 4990) AS k", "concat('t', id) AS t")
    facts = spark.range(100).selectExpr("concat('k', id) AS k")
    found = lookups.lookup(facts, table, ["k"], limit=10)
    expected = {(f"k{n}", min(f"t{n}", f"t{n + 4990}") if n < 10 else f"t{n}") for n in range(100)}
    assert {(r["k"], r["t"]) for r in found.collect()} == expected
    tied = lookups.first_by_key_hashed(table, ["k"])
    tied.collect()
    plan = tied._jdf.queryExecution().executedPlan().toString()
    assert plan.index("HashAggregate") < plan.index("SortAggregate")


def test_rows_run_once_where_the_runtime_splits_hot_keys(pair, monkeypatch):
    """A table above the limit doesn't make the session count the keys of the rows first."""
    sales, table = pair
    monkeypatch.setattr(lookups, "hot_keys", lambda *_: pytest.fail("rows run twice"))
    rows = lookups.lookup(sales, table, {"K": "KEY"}, limit=0).collect()
    assert {tuple(r) for r in rows} == EXPECTED | {(None, 5, None, None)}


def test_rows_stay_where_their_key_was_found(spark):
    rows = spark.range(1000).selectExpr("concat('k', id % 50) AS k", "id % 2 AS part", "id AS v")
    table = rows.select("k").distinct().withColumn("name", F.upper("k"))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        found = lookups.lookup(rows, table, ["k"], limit=0, place="place")
        sums = found.groupBy("k", "name", "part", "place").agg(F.sum("v").alias("v"))
        plan = sums._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan[: plan.index("SortMergeJoin")]
        expected = rows.groupBy("k", "part").agg(F.sum("v").alias("v"))
        assert sorted((r["k"], r["part"], r["v"]) for r in sums.collect()) == sorted(map(tuple, expected.collect()))
    finally:
        spark.conf.set(threshold, before)


def test_rows_move_once_for_lookups_by_one_key(spark):
    rows = spark.range(1000).selectExpr("if(id % 9 = 0, null, concat('k', id % 50)) AS k", "id AS v")
    keys = rows.select("k").where("k != 'k7'").distinct()
    upper, length = keys.withColumn("name", F.upper("k")), keys.withColumn("size", F.length("k"))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        found = lookups.lookup(rows, upper, ["k"], limit=0, place="place")
        found = lookups.lookup(found, length, ["k"], limit=0, place="place").drop("place")
        plan = found._jdf.queryExecution().executedPlan().toString()
        # after the outer join and its sort comes the inner join, without a shuffle of its rows
        assert "Exchange" not in plan[: plan.rindex("SortMergeJoin", 0, plan.index("Range"))]
        expected = {(k, v, k and k != "k7" and k.upper() or None, len(k) if k and k != "k7" else None) for k, v in map(tuple, rows.collect())}
        assert {tuple(r) for r in found.collect()} == expected and found.count() == 1000
    finally:
        spark.conf.set(threshold, before)
