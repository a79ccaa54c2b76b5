"""Quality rules, mixing and sharding: the operators in DataFrame functions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyloom.llm import mixing, quality, ranks, sharding
from tests.comparison import connect, differences
from tests.llm.conftest import rows_of

SF_DIR = "/root/testdata/sf0.001"
NATIVE = ["op3_quality_rules", "op5_mixing", "op10_sharding"]


@pytest.mark.parametrize("name", ["op3_quality_rules", "op5_mixing", "op7_line_dedup"])
def test_query_matches_sql(spark, name):
    con = connect(SF_DIR)
    assert not differences(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name])


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_in_native_plans(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def repeated(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    return len({p for i, w in enumerate(windows) if seen[w] > 1 for p in (i, i + 1, i + 2)})


def test_repeated_words_against_brute_force(spark, documents):
    rng = random.Random(5)
    texts = ["", None, "a", "a a", "a a a", "a a a a", "x y z x y z", " a b c a"]
    texts += [" ".join(rng.choice("abcd") for _ in range(rng.randint(3, 40))) for _ in range(60)]
    docs = documents(*enumerate(texts))
    found = {r["doc_id"]: r for r in quality.report(docs).collect()}
    assert len(found) == len(texts)
    for n, text in enumerate(texts):
        assert found[n]["n_repeat_words"] == repeated(text or ""), text


def test_repeats_around_a_window_of_like_hash(spark, documents):
    """Two windows whose hashes agree in 40 bits, one of them between the other two."""
    text = "a pq w596219 x1 x2 a pq w1768101 x3 x4 a pq w596219"
    found = quality.report(documents((1, text), (2, text + " " + text))).collect()
    assert {r["doc_id"]: r["n_repeat_words"] for r in found} == {1: 6, 2: repeated(text + " " + text)}


def test_length_alone_rejects_nothing(spark, documents):
    rng = random.Random(3)
    long = " ".join(f"word{rng.randrange(1000)}" for _ in range(30_000))
    dull = " ".join(f"word{rng.randrange(30)}" for _ in range(30_000))
    docs = documents((1, long), (2, dull), (3, ""), (4, " ".join(f"word{i}" for i in range(1001))))
    assert {r["doc_id"] for r in quality.passing(docs).collect()} == {1, 4}
    assert {r["doc_id"] for r in quality.report(docs).collect() if r["kept"]} == {1, 4}
    words = F.split("text", " ")
    judged = docs.select("doc_id", quality.little_variety(words).alias("x")).collect()
    assert {r["doc_id"]: r["x"] for r in judged} == {1: False, 2: True, 3: False, 4: False}


def test_quality_cases(spark, documents):
    clean = " ".join(f"word{i}" for i in range(60))
    rows = [
        (1, clean), (1, clean), (2, None), (3, ""), (4, "#* " * 60 + clean), (5, clean.upper()),
        (6, "\n".join([clean] + ["one more line here"] * 9)), (None, clean),
        (7, clean + " x" * 10),
    ]
    docs = documents(*((i, t, None, 9, "y") for i, t in rows), extra=", words int, kept string")
    kept = [(r["doc_id"], r["kept"]) for r in quality.report(docs).collect()]
    assert sorted(kept, key=repr) == sorted(
        [(1, True), (1, True), (2, False), (3, False), (4, False), (5, False), (6, False),
         (None, True), (7, True)], key=repr,
    )
    passing = quality.passing(docs)
    assert passing.columns == docs.columns
    assert sorted((r["doc_id"] for r in passing.collect()), key=repr) == [1, 1, 7, None]
    assert quality.passing(docs.limit(0)).count() == quality.report(docs.limit(0)).count() == 0


def test_rule_order_changes_no_verdict(spark, documents):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    few, many = (rows_of(quality.report(docs, sample_rows=n)) for n in (1, 2000))
    assert few == many


def test_running_totals_with_a_hot_group_and_ties(spark):
    rows = spark.range(3000).selectExpr(
        "if(id % 3 = 0, concat('k', id % 7), 'hot') AS g", "id % 5 AS o", "1L AS v"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        found = ranks.running_totals(rows, ["g"], ["o"], rows["v"], "before").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for group in {r["g"] for r in found}:
        own = sorted((r["before"], r["o"]) for r in found if r["g"] == group)
        assert [b for b, _ in own] == list(range(len(own)))
        assert [o for _, o in own] == sorted(o for _, o in own)


def filled(sizes, weights, total):
    """Targets by sharing what is left over again and again."""
    target, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    left = total
    while open_:
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_mix_targets_and_copies(spark, documents):
    rng = random.Random(1)
    rows = []
    for source, n in (("a", 5), ("b", 400), ("c", 60), (None, 30), ("d", 1)):
        for _ in range(n):
            rows.append((len(rows), "w " * rng.randint(0, 30), source))
    rows.append((None, None, "d"))
    found = mixing.plan_mix(documents(*rows)).collect()
    assert len(found) == len(rows)
    of = {i: s for i, _, s in rows}
    order = ["a", "b", "c", "d", None]
    sizes = {s: sum(r["size"] for r in found if of[r["doc_id"]] == s) for s in order}
    weights = dict(zip(order, [3, 1, 2, 3, 1], strict=True))
    expected = filled(sizes, weights, 1.5 * sum(sizes.values()))
    for s in order:
        own = [r for r in found if of[r["doc_id"]] == s]
        assert own[0]["target"] == pytest.approx(expected[s])
        assert abs(sum(r["size"] * r["copies"] for r in own) - expected[s]) <= 62
        assert {r["copies"] for r in own} <= {0, 1, 2}
    again = mixing.plan_mix(documents(*reversed(rows))).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


@pytest.mark.parametrize("plan, column", [(mixing.plan_mix, "copies"), (sharding.assign_shards, "shard")])
def test_reruns_agree_where_ids_tie(spark, documents, plan, column):
    """Null and repeated ids with different texts, read in 3 and in 7 partitions."""
    docs = documents(*((i % 40 if i % 2 else None, f"w {i} " * (i % 5), "abc"[i % 3]) for i in range(600)))
    found = [
        sorted((r["row_key"], r[column]) for r in plan(docs.repartition(n, "text")).collect()) for n in (3, 7)
    ]
    assert found[0] == found[1]


def test_rows_with_maps(spark):
    rows = [(1, "a b", "s", {"x": 1}), (1, "a b", "s", {"x": 2}), (2, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, tags map<string,int>")
    assert sharding.shard_documents(docs, shards=2).count() == 3
    assert mixing.mix(docs).columns == docs.columns


def test_mixed_rows(spark, documents):
    docs = documents(*((i % 4, "a b", "s", i // 4) for i in range(12)), extra=", copies int")
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.mix(docs).count() == 18
    repeated_row = documents(*[(1, "a b c", "s")] * 10)
    assert rows_of(mixing.mix(repeated_row)) == [(1, "a b c", "en", "s", 5)] * 15
    assert mixing.mix(docs.limit(0)).count() == mixing.plan_mix(docs.limit(0)).count() == 0
    assert mixing.mix(documents((1, None, None))).count() in (0, 1)


def test_shards(spark, documents):
    rows = [(i, f"text {i}", "abc"[i % 7 // 3]) for i in range(203)]
    rows += [(500, None, None)] * 3 + [(None, "ü", "a"), (None, "ü", "a")]
    docs = documents(*rows)
    found = sharding.assign_shards(docs).collect()
    per_shard = Counter(r["shard"] for r in found)
    assert len(per_shard) == 8 and max(per_shard.values()) - min(per_shard.values()) <= 1
    for shard, n in per_shard.items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(n))
    texts = {i: t for i, t, _ in rows}
    for r in found:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
    whole = sharding.shard_documents(docs)
    assert whole.columns == [*docs.columns, "shard", "slot"] and whole.count() == len(rows)
    mix = Counter((r["source"], r["shard"]) for r in whole.collect())
    for source in ("a", "b", "c"):
        counts = [mix[source, s] for s in range(8)]
        assert max(counts) - min(counts) <= 2
    assert sharding.assign_shards(docs.limit(0)).count() == 0


def test_shard_query_against_brute_force(spark):
    """Ranks within sources, fractional ranks and the cut, redone in plain Python."""
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    order, per_source = [], Counter(r["source"] for r in rows)
    for source in per_source:
        own = sorted(
            (hashlib.md5(f"10:{r['doc_id']}".encode()).hexdigest(), r["doc_id"])
            for r in rows if r["source"] == source
        )
        order += [((2 * n + 1) / (2 * len(own)), "0" + source, *x) for n, x in enumerate(own)]
    expected, slots = {}, Counter()
    for at, (*_, doc_id) in enumerate(sorted(order)):
        shard = at * 8 // len(order)
        expected[doc_id] = (shard, slots[shard])
        slots[shard] += 1
    found = entry.queries()["op10_sharding"](spark, SF_DIR).collect()
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in found} == expected and len(found) == len(rows)


def test_written_shards(spark, documents, tmp_path):
    docs = documents(*((i, f"t{i}", "s") for i in range(40)))
    sharding.write_shards(sharding.shard_documents(docs), str(tmp_path / "out"), 2)
    read = spark.read.parquet(str(tmp_path / "out"))
    assert read.count() == 40 and read.select("shard").distinct().count() == 8
