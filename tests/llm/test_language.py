"""Language-model scoring by a suffix tree."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tallyloom.llm import language

SF_DIR = "/root/testdata/sf0.001"


def tokens_of(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", text), None]


class SlowTree:
    """Distributions by the definition, over dictionaries of all sequences."""

    def __init__(self, texts, depth, share):
        self.depth = depth
        sequences = [Counter() for _ in range(depth + 1)]
        for text in texts:
            tokens = tokens_of(text)
            for i in range(len(tokens)):
                for k in range(1, min(depth + 1, i + 1) + 1):
                    sequences[k - 1][tuple(tokens[i + 1 - k : i + 1])] += 1
        self.words = sequences[0]
        self.total = sum(self.words.values())
        least = max(2, share * self.total)
        self.after = defaultdict(dict)
        for counted in sequences[1:]:
            for s, n in counted.items():
                if n >= least:
                    self.after[s[:-1]][s[-1]] = n
        self.count = {s: n for counted in sequences for s, n in counted.items()}
        self.states = set()
        for s in sorted(self.after, key=len):
            total, kept = self.count[s], self.after[s]
            rest = 1 - sum(n - 0.75 for n in kept.values()) / total
            gain = sum(n * math.log(self.own(s, w, rest) / self.p(s[1:], w)) for w, n in kept.items())
            gain += (total - sum(kept.values())) * math.log(rest)
            if gain >= 0.01 * total:
                self.states.add(s)

    def base(self, word):
        return (self.words[(word,)] + 1) / (self.total + len(self.words) + 1)

    def own(self, s, word, rest):
        return max(self.after[s].get(word, 0) - 0.75, 0) / self.count[s] + rest * self.p(s[1:], word)

    def p(self, history, word):
        s = tuple(history)[-self.depth :] if self.depth else ()
        while s and s not in self.states:
            s = s[1:]
        if not s:
            return self.base(word)
        rest = 1 - sum(n - 0.75 for n in self.after[s].values()) / self.count[s]
        return self.own(s, word, rest)


def slow_scores(rows, depth=language.DEPTH, share=language.SHARE):
    held = [zlib.crc32(str(i if i is not None else "").encode()) % 7 == 2 for i, _ in rows]
    tree = SlowTree([t for (_, t), h in zip(rows, held, strict=True) if not h], depth, share)
    out = []
    for (i, text), h in zip(rows, held, strict=True):
        tokens = tokens_of(text)
        known = sum(tree.words[(w,)] > 0 for w in tokens)
        base = sum(math.log10(tree.base(w)) for w in tokens)
        score = sum(math.log10(tree.p(tokens[:n], w)) for n, w in enumerate(tokens))
        out.append((i, h, len(tokens), known, tree.total, base, score))
    return out, tree


def same(found, expected):
    found = sorted(map(tuple, found.collect()), key=lambda r: (repr(r[:5]), r[5], r[6]))
    expected = sorted(expected, key=lambda r: (repr(r[:5]), r[5], r[6]))
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    for a, b in zip(found, expected, strict=True):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


@pytest.mark.parametrize("depth, share", [(0, 2e-7), (1, 2e-3), (2, 2e-7), (3, 2e-4)])
def test_scores_against_brute_force(spark, documents, monkeypatch, depth, share):
    """Repeats, nulls, odd white space, words of held-out texts only; in small slices as well."""
    monkeypatch.setattr(language, "SLICE_BYTES", 500)
    rng = random.Random(5)
    words = "the The cat sat on mat ÉTÉ été dog ran over a an it is".split()
    chain = {w: rng.choices(words, k=3) for w in words}
    rows = []
    for i in range(120):
        word, text = rng.choice(words), []
        for _ in range(rng.randint(0, 40)):
            text.append(word if rng.random() < 0.95 else f"rare{rng.randrange(60)}")
            word = rng.choice(chain[word])
        rows.append((i, rng.choice([" ", "\n", "\t ", "\x0b"]).join(text)))
    rows += [(200, None), (201, ""), (202, " \n "), (None, "the cat"), (7, "the cat sat"), (7, "the cat sat"),
             (203, "zz " * 5000), (204, " lead and trail\xa0 ")]
    docs = documents(*((i, t, None, 5) for i, t in rows), extra=", score int")
    expected, tree = slow_scores(rows, depth, share)
    same(language.score(docs, depth, share), expected)
    for history in ([], ["the"], ["the", "cat"], ["sat", "on", "a"]):
        whole = sum(tree.p(history, w) for (w,) in tree.words) + tree.p(history, "never seen")
        assert whole == pytest.approx(1)
    assert not depth or tree.states


@pytest.mark.parametrize("depth, common", [(2, 2e-2), (3, 4e-3), (2, 1.0)])
def test_sequences_that_are_not_broadcast_are_in_the_tree(spark, documents, monkeypatch, depth, common):
    """Whatever part of the training tokens a broadcast sequence must have, and with crowded filters."""
    monkeypatch.setattr(language, "SLICE_BITS", 64)
    monkeypatch.setattr(language, "MOST_BITS", 256)
    rng = random.Random(6)
    words = "a b c d e f g h".split()
    chain = {w: rng.choices(words, k=2) for w in words}
    rows = [(900, "one twice told tale"), (901, "one twice told tale"), (902, None)]
    for i in range(80):
        word, text = rng.choice(words), []
        for _ in range(rng.randint(0, 30)):
            text.append(word if rng.random() < 0.8 else f"r{rng.randrange(40)}")
            word = rng.choice(chain[word])
        rows.append((i, " ".join(text)))
    expected, _ = slow_scores(rows, depth, 0.0)
    same(language.score(documents(*rows), depth, common=common), expected)


def test_no_share_of_the_tokens_is_asked_for():
    """A cut that grows with the corpus would drop sequences that a small corpus keeps."""
    assert language.SHARE == 0


def test_sequences_move_packed_and_tables_go_once_used(spark, documents):
    """Occurrences aren't rows of a join, and counts don't stay stored beside the tree."""
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {path.name for path in shared.iterdir()}
    scores = language.score(documents(*((i, "a b c d a b") for i in range(20))))
    assert "Generate" not in scores._jdf.queryExecution().executedPlan().toString()
    stored = {path.name.rsplit("-", 1)[0] for path in shared.iterdir() if path.name not in before}
    assert stored == {"word-counts", "sequences", "scored", "added"}
    assert scores.count() == 20


def test_empty_and_untrained(spark, documents):
    assert language.score(documents((1, "a")).limit(0)).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (row,) = language.score(documents((held, "a b"))).collect()
    assert tuple(row) == (held, True, 3, 0, 0, 0.0, 0.0)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    expected, _ = slow_scores([tuple(r) for r in docs])
    found = entry.queries()["op12_suffix_tree"](spark, SF_DIR)
    same(found, expected)
    held = [r for r in expected if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)
