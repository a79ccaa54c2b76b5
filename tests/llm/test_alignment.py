"""Cross-tokenizer alignment."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tallyloom.llm import alignment, counting

SF_DIR = "/root/testdata/sf0.001"
FOLDER = Path(alignment.TOKENIZERS)


@pytest.fixture(scope="module")
def own():
    return alignment.Tokenizers(*((FOLDER / name).read_bytes() for name in (alignment.BYTE_BPE, alignment.PIECE_BPE)))


@pytest.fixture(scope="module")
def plain():
    """Both tokenizers by their own libraries, and the bytes of their tokens."""
    a = Tokenizer.from_file(str(FOLDER / alignment.BYTE_BPE))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=str(FOLDER / alignment.PIECE_BPE))
    chars = [c for c in map(chr, range(256)) if c.isprintable() and c not in " ­"]
    rest = iter(map(chr, range(256, 400)))
    char_of = {n: chr(n) if chr(n) in chars else next(rest) for n in range(256)}
    byte_of = {c: n for n, c in char_of.items()}

    def piece(n):
        name = b.id_to_piece(n)
        return bytes([int(name[3:5], 16)]) if b.is_byte(n) else name.replace("▁", " ").encode()

    def encode(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids
        return (
            [(n, bytes(byte_of[c] for c in a.id_to_token(n))) for n in ids],
            [(n, piece(n)) for n in b.encode(text)],
        )

    return encode


def slow_alignment(encode, text):
    """Groups and links by comparing the byte ranges of all token pairs near each other."""
    if not text:
        return None
    a, b = encode(text)
    whole = b" " + text.encode()
    if b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
        return None

    def ranges(tokens):
        at, out = 0, []
        for n, token in tokens:
            out.append((n, at, at + len(token)))
            at += len(token)
        return out

    a, b = ranges(a), ranges(b)
    links, first = [], 0
    for n, start, end in a:
        while first < len(b) and b[first][2] <= start:
            first += 1
        j = first
        while j < len(b) and b[j][1] < end:
            links.append((n, b[j][0]))
            j += 1
    cuts = sorted({e for *_, e in a} & {e for *_, e in b})
    groups, low = [], 0
    for cut in cuts:
        sides = (",".join(str(n) for n, s, e in side if low <= s and e <= cut) for side in (a[:], b[:]))
        groups.append("|".join(sides))
        a = [x for x in a if x[1] >= cut]
        b = [x for x in b if x[1] >= cut]
        low = cut
    return links, groups


def slow_report(encode, rows):
    found = [(i, t, slow_alignment(encode, t)) for i, t in rows]
    count = Counter(pair for *_, x in found if x for pair in x[0])
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for i, text, x in found:
        if not x:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links, groups = x
        n_a, n_b = (sum(len(g.split("|")[k].split(",")) for g in groups) for k in (0, 1))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        n_best = sum(count[p] == best[p[1]] for p in links)
        out.append((i, n_a, n_b, len(groups), len(links), n_best, sum(count[p] for p in links), digest))
    return sorted(out, key=repr)


ODD = ["", None, " ", "a", "  two  spaces ", "<|endoftext|> and <s> </s> <unk>", "tab\tline\n\n end ",
       "▁ low line block", "é́ é ﬁ Å", "日本語の文 и кириллица", "\x00\x01\x02 nul", "🙂🙃 emoji",
       "x" * 3000, "don't can't 12345 --- !!!", " 　 wide", "\r\n\r\n", "ab" * 5000 + " end"]


def test_tokens_are_those_of_the_libraries(own, plain):
    rng = random.Random(13)
    texts = [t for t in ODD if t] + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x3000)])) for _ in range(60)) for _ in range(200)]
    for text in texts:
        a, b = plain(text)
        assert own.a.encode_ordinary(" " + text) == [n for n, _ in a]
        assert all(own.a_bytes[n] == token for n, token in a)
        assert all(own.b_bytes[n] == token for n, token in b)


@pytest.mark.parametrize("tokens, table_bytes", [(alignment.LANE_TOKENS, alignment.TABLE_BYTES), (3, 200)])
def test_report_against_brute_force(spark, documents, plain, monkeypatch, tokens, table_bytes):
    """Odd texts, long ones in many lanes, repeats and null ids; also with pair counts in many blocks."""
    if tokens == 3:
        monkeypatch.setattr(alignment, "GROUP_BYTES", 100)
        rows = list(enumerate(ODD[:10]))
    else:
        rows = [*enumerate(ODD), (None, "once more"), (3, "a"), (3, "a"), (50, "the long one, " * 3000)]
    docs = documents(*((i, t, None, "x") for i, t in rows), extra=", links string")
    found = alignment.alignment_report(docs, tokens=tokens, table_bytes=table_bytes)
    assert sorted(map(tuple, found.collect()), key=repr) == slow_report(plain, rows)
    assert alignment.alignment_report(docs.limit(0)).count() == 0


def test_query_against_brute_force(spark, plain):
    found = entry.queries()["op13_token_alignment"](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, found.collect()), key=repr) == slow_report(plain, map(tuple, docs))


def test_tally_hands_on_all_counts():
    rng = np.random.default_rng(1)
    tally, seen, out = counting.Tally(most=40), Counter(), Counter()
    for _ in range(30):
        keys = rng.integers(0, 60, 25)
        seen.update(keys.tolist())
        tally.add(keys)
        for batch in [*tally.overflow("k")]:
            out.update(dict(zip(*(c.to_pylist() for c in batch.columns), strict=True)))
        assert tally.size <= 65
    for batch in tally.rest("k"):
        out.update(dict(zip(*(c.to_pylist() for c in batch.columns), strict=True)))
    assert out == seen and not [*tally.rest("k")]
