"""Ranked lexical search."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

import __spark_entry__ as entry
from tallyloom.llm import lexical
from tests.comparison import connect, differences

SF_DIR = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow_ranks(docs, items, most=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n = [sum(c.values()) for _, c in counts]
    documents, length = sum(x > 0 for x in n), sum(n)
    out = []
    for item_id, text in items:
        scored = []
        for (doc_id, c), size in zip(counts, n, strict=True):
            score = 0
            for term, times in Counter(terms(text)).items():
                if tf := c[term]:
                    df = sum(term in other for _, other in counts)
                    w = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
                    m = 100 - 75 + 75 * size * documents // length
                    score += times * w * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, *_, doc_id) in enumerate(sorted(scored)[:most], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=repr)


def ranks(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block_bytes, held", [(lexical.BLOCK_BYTES, lexical.SCORES_HELD), (60, 5)])
def test_ranks_against_brute_force(spark, documents, monkeypatch, block_bytes, held):
    """Ties, repeats, nulls, long texts, non-ASCII letters; also block by block."""
    rng = random.Random(11)
    words = ["the", "The", "cat", "größe", "Ünit", "x1", "a", "don't", "e-mail", "日本", "zz"]
    rows = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(90)]
    rows += [(7, "the cat"), (7, "the cat"), (None, "the cat"), (200, None), (201, ""), (202, "... !"),
             (203, "the " * 50_000), (204, "theca the\x00cat")]
    items = [(1, "The cat, the cat"), (2, None), (3, ""), (4, "größe 日本"), (4, "größe 日本"), (5, "absent"),
             (6, "zz e-mail x1 don't"), (7, "..")]
    docs = documents(*((i, t, None, 1) for i, t in rows), extra=", score int")
    table = spark.createDataFrame(items, "item_id bigint, text string")
    found = lexical.rank_documents(docs, table, block_bytes=block_bytes)
    assert ranks(found) == slow_ranks(rows, items)
    assert ranks(lexical.rank_documents(docs, table, 3, block_bytes)) == slow_ranks(rows, items, 3)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]


def test_empty_tables(spark, documents):
    docs = documents((1, "a b"))
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert lexical.rank_documents(docs.limit(0), items).count() == 0
    assert lexical.rank_documents(docs, items.limit(0)).count() == 0
    assert lexical.rank_documents(documents((1, None), (2, "..")), items).count() == 0


def test_query_against_sql_and_brute_force(spark):
    found = entry.queries()["op11_lexical_search"](spark, SF_DIR)
    assert not differences(found, connect(SF_DIR), entry.oracle_sql()["op11_lexical_search"])
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").where("item_id % 10 = 0").collect()
    assert [r for r in ranks(found) if r[0] % 10 == 0] == slow_ranks(docs, items)
