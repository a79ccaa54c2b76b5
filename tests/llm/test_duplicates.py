"""SimHash components, line dedup and benchmark decontamination."""

from __future__ import annotations

import hashlib
import random
import time

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from tallyloom.llm import components, decontamination, line_dedup, simhash
from tests.llm.conftest import rows_of

SF_DIR = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    words = [w for w in _split((text or "").encode()) if w]
    words = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]
    if not words:
        return 0
    n = max(1, len(words) - 3)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _split(data):
    for space in b"\t\n\x0b\x0c\r":
        data = data.replace(bytes([space]), b" ")
    return data.split(b" ")


def slow_components(prints):
    """prints: (doc_id, fingerprint); component_id by flooding."""
    label = {p: None for _, p in prints}
    least = {}
    for start in label:
        if label[start] is not None:
            continue
        label[start], stack = start, [start]
        while stack:
            p = stack.pop()
            for q in label:
                if label[q] is None and (p ^ q).bit_count() <= 4:
                    label[q] = start
                    stack.append(q)
    for i, p in prints:
        if i is not None:
            least[label[p]] = min(i, least.get(label[p], i))
    return {(i, p): least.get(label[p]) for i, p in prints}


def test_simhash_query_against_brute_force(spark):
    found = entry.queries()["op8_simhash"](spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r["doc_id"], slow_fingerprint(r["text"])) for r in docs]
    expected = slow_components(prints)
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found) == sorted(
        (i, f"{p:016x}", expected[i, p]) for i, p in prints
    )


def test_simhash_cases(spark, documents):
    docs = documents((1, None), (2, ""), (3, " "), (None, "A b"), (4, "a\tB"), (4, "a\tB"),
                     (None, "only here"), (9, "x " * 300_000))
    found = {
        (r["doc_id"], r["fingerprint"], r["component_id"])
        for r in simhash.near_duplicates(docs).collect()
    }
    signed = lambda t: int(np.uint64(slow_fingerprint(t)).view(np.int64))
    assert (1, 0, 1) in found and (2, 0, 1) in found and (3, signed(" "), 3) in found
    assert (None, signed("a b"), 4) in found and (4, signed("a b"), 4) in found
    assert (None, signed("only here"), None) in found
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 3, 4, 9, None]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.without_near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("crowd", [False, True])
def test_links_lose_no_component(spark, monkeypatch, crowd):
    """Chains, dense balls and strangers; also when every bucket counts as crowded."""
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(300)}
    for center in list(prints)[:4]:
        for _ in range(60):
            step = center
            for bit in rng.sample(range(64), 4):
                step ^= 1 << bit
            prints.add(step)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint bigint")
    if crowd:
        crowded = spark.createDataFrame([(p, None) for p in signed], "a bigint, b bigint")
        tables = simhash._tables
        monkeypatch.setattr(
            simhash, "_tables", lambda d, b: tables(d, b) if b == simhash.FINEST else crowded
        )
    links = simhash.fingerprint_links(df)
    roots = {r["node"]: r["root"] for r in components.connected_components(links, "a", "b").collect()}
    expected = slow_components([(n, p) for n, p in enumerate(prints)])
    groups = {}
    for n, p in enumerate(prints):
        groups.setdefault(expected[n, p], set()).add(roots.get(signed[n], signed[n]))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_crowded_buckets_are_handed_on(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(simhash, "MOST_IN_BUCKET", 3)
    schema = pa.schema([("t", pa.int32()), ("k", pa.int64()), ("f", pa.int64())])
    rows = [(0, 5, 1), (0, 5, 3), (0, 6, 100), *((0, 7, i) for i in range(1, 6)), (1, 7, 8), (1, 7, 9)]
    for size in (1, 2, 3, 20):
        batches = [
            pa.RecordBatch.from_pylist([dict(zip("tkf", r, strict=True)) for r in rows[i : i + size]], schema)
            for i in range(0, len(rows), size)
        ]
        out = [tuple(r.values()) for b in simhash._link_buckets(iter(batches)) for r in b.to_pylist()]
        assert sorted(out, key=repr) == sorted([(1, 3), *((i, None) for i in range(1, 6)), (8, 9)], key=repr)


def test_bands_are_exact():
    rng = random.Random(4)
    for bands in (6, 8, 16):
        masks = [m % (1 << 64) for m in simhash.masks(bands)]
        for _ in range(200):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), 4):
                b ^= 1 << bit
            assert any(a & m == b & m for m in masks)
    assert simhash.bands_for(0) == 6 and simhash.bands_for(10**10) > 8


def test_long_chain_is_one_component(spark):
    links = spark.range(1, 200).selectExpr("id AS a", "id - 1 AS b")
    found = components.connected_components(links, "a", "b").collect()
    assert len(found) == 200 and {r["root"] for r in found} == {0}
    assert components.connected_components(links.limit(0), "a", "b").count() == 0


def slow_lines(rows, least=10):
    space, first = " \t\n\x0b\x0c\r", {}
    key = lambda line: line.strip(space).encode().lower().decode()
    order = lambda i: (i is None, i or 0)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                k = key(line)
                first[k] = min(first.get(k, order(i)), order(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if first.get(key(x), order(i)) == order(i)]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((i, len(lines), len(lines) - len(kept), digest))
    return sorted(out, key=repr)


@pytest.mark.parametrize("partitions", ["1", "4", "23"])
def test_line_dedup_against_brute_force(spark, documents, partitions):
    """A line in every document lies in many partitions and is settled between them."""
    rng = random.Random(6)
    pool = [f"line number {i:03d} of the pool" for i in range(40)] + ["short", "ÄÖÜäöü ß€", " "]
    rows = [
        (i, "\n".join(["A very Common line", *(rng.choice(pool) for _ in range(rng.randint(0, 12)))]))
        for i in range(1, 120)
    ]
    rows += [(5, "a VERY common line\t"), (5, rows[4][1]), (None, "a very common line"), (200, None),
             (201, ""), (202, "x\n" * 5000 + "a very common line"), (None, None)]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = rows_of(line_dedup.digest(documents(*rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == slow_lines(rows)
    assert line_dedup.digest(documents((1, "x")).limit(0)).count() == 0


def slow_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_decontamination_query_against_brute_force(spark):
    found = entry.queries()["op6_decontamination"](spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    items = [(r["item_id"], f" {decontamination.fold(r['text'])} ") for r in items]
    expected = set()
    for d in docs:
        text = f" {decontamination.fold(d['text'])} "
        for item_id, item in items:
            # no match without a piece, so only texts with a common piece are measured
            budget = int((len(item) - 2) * decontamination.ERROR_RATE)
            if any(p in text for _, p in decontamination.pieces(item, budget)):
                distance = slow_distance(item, text)
                if distance <= budget:
                    expected.add((d["doc_id"], item_id, distance))
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in found} == expected and expected


def test_edited_items_are_found(spark, documents):
    rng = random.Random(8)
    item = " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(20))
    budget = int(len(item) * decontamination.ERROR_RATE)
    rows, expected = [(0, None), (1, ""), (2, item[:60]), (None, "x " + item.upper() + "!")], {(None, 0)}
    for errors in (1, budget // 2, budget, budget + 40):
        edited = list(item)
        for at in rng.sample(range(1, len(item) - 1), errors):
            edited[at] = rng.choice(["", edited[at] + "q", "z"])
        rows.append((10 + errors, "start " * 50 + "".join(edited) + " end" * 50))
        distance = slow_distance(item, decontamination.fold(rows[-1][1]))
        if distance <= budget:
            expected.add((10 + errors, distance))
    benchmark = spark.createDataFrame(
        [(7, item), (7, item), (8, None), (9, ""), (10, "!!!")], "item_id bigint, text string"
    )
    docs = documents(*rows)
    for block_bytes in (1 << 20, 100):
        found = decontamination.find_items(docs, benchmark, block_bytes=block_bytes).collect()
        assert {(r["doc_id"], r["distance"]) for r in found} == expected
        assert len(found) == 2 * len(expected) and {r["item_id"] for r in found} == {7}
        clean = decontamination.without_items(docs, benchmark, block_bytes=block_bytes)
        assert clean.columns == docs.columns and clean.count() == len(rows) - len(expected)
    assert decontamination.find_items(docs.limit(0), benchmark).count() == 0
    assert decontamination.without_items(docs, benchmark.limit(0)).count() == len(rows)


def test_repeated_text_is_read_once_a_window(spark, documents):
    """Texts of an item's own words over and over, and the item's place in them."""
    rng = random.Random(3)
    item = "abcd " * 100
    search = decontamination.Items([(1, item)], decontamination.ERROR_RATE)
    began = time.perf_counter()
    broken = " ".join("abcd" if rng.random() < 0.9 else "xyz" for _ in range(100_000))
    found = search.matches(broken)
    assert time.perf_counter() - began < 60
    near = [" ".join("abcd" if rng.random() < p else "xyz" for _ in range(160)) for p in (0.8, 0.9, 0.95, 0.99, 1)]
    for text in near:
        distance = slow_distance(f" {decontamination.fold(item)} ", f" {text} ")
        found = search.matches(text)
        assert found.get(0, (None,))[0] == (distance if distance <= 39 else None)
        if found:
            _, start, end = found[0]
            assert slow_distance(f" {decontamination.fold(item)} ", f" {text[start:end]} ") == distance


def test_short_items_are_met_at_word_boundaries(spark, documents):
    docs = documents((1, "concatenate"), (2, "The CAT!"), (3, "cat"), (4, "a cat sat"), (5, "scat cats"))
    items = spark.createDataFrame([(1, "cat"), (2, "a")], "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"], r["start"], r["end"]) for r in decontamination.find_items(docs, items).collect()}
    assert found == {(2, 1, 4, 7), (3, 1, 0, 3), (4, 1, 2, 5), (4, 2, 0, 1)}
