"""Two tokenizers' tokens of each text, aligned by lockstep merging of their ends."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.counting import Tally
from tallyloom.llm.storage import written

# Where the vocabularies lie on the driver, and the two files.
TOKENIZERS = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
# Texts are aligned in groups of about this many bytes; long ones in lanes of about this
# many tokens.
GROUP_BYTES = 4 * 1024 * 1024
LANE_TOKENS = 1024
# Pair counts that a task holds at once.
TABLE_BYTES = 64 * 1024 * 1024
PAIR_BYTES = 16

# Fixed value: how the byte-level vocabulary splits a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Ids of B take this many bits in a pair.
B_BITS = 16


def byte_of_char() -> dict[str, int]:
    """The characters by which a byte-level vocabulary writes bytes."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers, from the contents of their files, and the bytes of their tokens.

    The vocabulary of A ranks its merges by id, so ids are the ranks; special tokens are
    left out, so that their strings are plain text.
    """

    def __init__(self, byte_bpe: bytes, piece_bpe: bytes) -> None:
        found = json.loads(byte_bpe)
        special = {token["id"] for token in found["added_tokens"] if token["special"]}
        byte_of = byte_of_char()
        ranks = {
            bytes(byte_of[c] for c in token): number
            for token, number in found["model"]["vocab"].items()
            if number not in special
        }
        self.a = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_bpe)
        self.a_bytes = [b""] * (max(found["model"]["vocab"].values()) + 1)
        for token, number in ranks.items():
            self.a_bytes[number] = token
        self.b_bytes = [self._piece(n) for n in range(self.b.get_piece_size())]
        if len(self.b_bytes) > 1 << B_BITS:
            raise ValueError(f"B has more than {1 << B_BITS} pieces")
        self.a_size, self.b_size = (
            np.array([len(token) for token in tokens], dtype=np.int64)
            for tokens in (self.a_bytes, self.b_bytes)
        )
        # an id with what follows it in a group: a comma, or the end of its side
        spelled = [f"{n}{end}".encode() for n in range(len(self.a_bytes)) for end in ",|"]
        self.b_from = len(spelled)
        self.spelled = spelled + [f"{n}{end}".encode() for n in range(len(self.b_bytes)) for end in ",;"]

    def _piece(self, number: int) -> bytes:
        if self.b.is_byte(number):
            return bytes([int(self.b.id_to_piece(number)[3:-1], 16)])
        return self.b.id_to_piece(number).replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """A's and B's ids of each text; none where either doesn't spell a space and the text."""
        a, b = [], self.b.encode(texts, num_threads=1)
        for n, text in enumerate(texts):
            whole = b" " + text.encode()
            ids = self.a.encode_ordinary(" " + text) if text else []
            if (
                b"".join(map(self.a_bytes.__getitem__, ids)) != whole
                or b"".join(map(self.b_bytes.__getitem__, b[n])) != whole
            ):
                ids = b[n] = []
            a.append(ids)
        return a, b


def lanes(
    a_first: np.ndarray, a_ends: np.ndarray, b_first: np.ndarray, b_ends: np.ndarray, tokens: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where lanes start in A's and in B's tokens, and where they stop in A's.

    A text is a lane; one of more than `tokens` of A's tokens is cut at the next end that
    B has as well, so that no lane is long and many can be merged at once.
    """
    a_starts, b_starts, a_stops = [], [], []
    for n in range(len(a_first) - 1):
        a, stop, b = int(a_first[n]), int(a_first[n + 1]), int(b_first[n])
        if a == stop:
            continue
        own_b = b_ends[b : b_first[n + 1]]
        while True:
            cut = a + tokens
            while cut < stop:
                block = a_ends[cut - 1 : min(cut + 63, stop)]
                place = np.searchsorted(own_b, block)
                shared = np.flatnonzero(own_b[place] == block)
                if len(shared):
                    cut += int(shared[0])
                    break
                cut += len(block)
            cut = min(cut, stop)
            a_starts.append(a)
            b_starts.append(b)
            a_stops.append(cut)
            if cut == stop:
                break
            a, b = cut, int(b_first[n]) + int(np.searchsorted(own_b, a_ends[cut - 1])) + 1
    return tuple(np.array(x, dtype=np.int64) for x in (a_starts, b_starts, a_stops))


def merge(
    a_ends: np.ndarray, b_ends: np.ndarray, a: np.ndarray, b: np.ndarray, a_stop: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (tokens of A, tokens of B) and cuts (likewise the last ones of each group).

    All lanes advance at once: in each step every lane links the two tokens it stands at,
    then goes on in A, in B, or where both end alike in both, which is a cut. Finished
    lanes leave the state.
    """
    links: tuple[list, list] = ([], [])
    cuts: tuple[list, list] = ([], [])
    while len(a):
        links[0].append(a)
        links[1].append(b)
        x, y = a_ends[a], b_ends[b]
        cut = x == y
        cuts[0].append(a[cut])
        cuts[1].append(b[cut])
        a, b = a + (x <= y), b + (y <= x)
        live = a < a_stop
        if not live.all():
            a, b, a_stop = a[live], b[live], a_stop[live]
    empty = [np.zeros(0, np.int64)]
    return tuple(np.concatenate(x or empty) for x in (*links, *cuts))


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    first = np.cumsum([0, *map(len, ids)])
    return np.fromiter(chain.from_iterable(ids), np.int64, count=int(first[-1])), first


def aligned(tokenizers: Tokenizers, texts: list[str], tokens: int = LANE_TOKENS) -> dict[str, list]:
    """Per text n_a, n_b, n_groups, n_links, groups_sha256 and links, its sorted pairs packed."""
    (a, a_first), (b, b_first) = map(_flat, tokenizers.encode(texts))
    # both spell the same bytes, so that running sums over all texts are comparable
    a_ends, b_ends = np.cumsum(tokenizers.a_size[a]), np.cumsum(tokenizers.b_size[b])
    link_a, link_b, cut_a, cut_b = merge(
        a_ends, b_ends, *lanes(a_first, a_ends, b_first, b_ends, tokens)
    )
    last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    last_a[cut_a] = last_b[cut_b] = True
    ends_a, ends_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
    # a token's place once each group has A's tokens, then B's
    before_b = np.concatenate(([0], ends_b))[np.cumsum(last_a) - last_a]
    up_to_a = ends_a[np.cumsum(last_b) - last_b] if len(b) else ends_a
    order = np.empty(len(a) + len(b), dtype=np.int64)
    order[np.arange(len(a)) + before_b] = 2 * a + last_a
    order[np.arange(len(b)) + up_to_a] = tokenizers.b_from + 2 * b + last_b
    of_text = np.repeat(np.arange(len(texts)), np.diff(a_first))
    text_of = of_text[link_a]
    pairs = np.sort(text_of.astype(np.uint64) << 32 | (a[link_a] << B_BITS | b[link_b]).astype(np.uint64))
    n_links = np.bincount(text_of, minlength=len(texts))
    stops = np.cumsum(n_links)
    pack = zstandard.ZstdCompressor(level=1).compress
    digests, packed = [], []
    for n in range(len(texts)):
        at, end = a_first[n] + b_first[n], a_first[n + 1] + b_first[n + 1]
        whole = b"".join(map(tokenizers.spelled.__getitem__, order[at:end].tolist()))
        digests.append(hashlib.sha256(whole[:-1]).hexdigest() if whole else "")
        own = pairs[stops[n] - n_links[n] : stops[n]].astype("<u4")
        packed.append(pack(np.diff(own, prepend=np.uint32(0)).astype("<u4").tobytes()) if whole else b"")
    return {
        "n_a": np.diff(a_first),
        "n_b": np.diff(b_first),
        "n_groups": np.bincount(of_text[cut_a], minlength=len(texts)),
        "n_links": n_links,
        "groups_sha256": digests,
        "links": packed,
    }


def pairs_of(packed: bytes) -> np.ndarray:
    """The sorted pairs of a text; a pair is A's id, then B's in `B_BITS` bits."""
    if not packed:
        return np.zeros(0, np.uint32)
    return np.cumsum(np.frombuffer(zstandard.decompress(packed), "<u4"), dtype=np.uint32)


def _groups(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Stretches of texts of about `most` characters."""
    start = size = 0
    for n, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, n
            start, size = n, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def align(docs: DataFrame, folder: str = TOKENIZERS, tokens: int = LANE_TOKENS) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256 and links.

    A encodes a space and the text, B the text, to which it adds the space itself. Byte
    offsets at which tokens of both end cut them into groups; a link is a token of A and
    one of B that share bytes. Texts that are null, empty, or that a tokenizer doesn't
    spell as they are have no tokens. Repeated rows get a row each.
    """
    files = [Path(folder, name).read_bytes() for name in (BYTE_BPE, PIECE_BPE)]
    shared = docs.sparkSession.sparkContext.broadcast(files)
    ready: list[Tokenizers] = []
    kinds = {"n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint"}
    kinds |= {"groups_sha256": "string", "links": "binary"}

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not ready:
            ready.append(Tokenizers(*shared.value))
        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            for start, stop in _groups(texts, GROUP_BYTES):
                found = aligned(ready[0], texts[start:stop], tokens)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), *map(pa.array, found.values())],
                    ["doc_id", *found],
                )

    return docs.select("doc_id", "text").mapInArrow(
        of_texts,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{k} {v}" for k, v in kinds.items()),
    )


def pair_counts(aligned_docs: DataFrame) -> DataFrame:
    """pair and n: how many links of all documents have the pair."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Tally()
        for batch in batches:
            packed = batch.column(0).to_pylist()
            for at in range(0, len(packed), 500):
                held.add(np.concatenate([pairs_of(x) for x in packed[at : at + 500]]).astype(np.int64))
                yield from held.overflow("pair")
        yield from held.rest("pair")

    return (
        aligned_docs.select("links").mapInArrow(tally, "pair bigint, n bigint")
        .groupBy("pair").agg(F.sum("n").alias("n"))
    )


def _with_counts(spark, rows: DataFrame, counts: DataFrame, best: np.ndarray) -> DataFrame:
    """n_best and count_sum raised by what the links of this block of counts add."""
    table = counts.orderBy("pair").toArrow()
    shared = spark.sparkContext.broadcast(
        (table.column("pair").to_numpy(), table.column("n").to_numpy(), best)
    )

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, highest = shared.value
        for batch in batches:
            n_best, count_sum = (batch.column(i).to_numpy().copy() for i in (1, 2))
            for i, packed in enumerate(batch.column(0).to_pylist()):
                own = pairs_of(packed).astype(np.int64)
                if len(own) and len(pairs):
                    place = np.searchsorted(pairs, own)
                    place[place == len(pairs)] = 0
                    found = np.where(pairs[place] == own, n[place], 0)
                    count_sum[i] += found.sum()
                    n_best[i] += np.count_nonzero((found > 0) & (found == highest[own & (1 << B_BITS) - 1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_best), pa.array(count_sum), *batch.columns[3:]],
                batch.schema.names,
            )

    return rows.mapInArrow(looked_up, rows.schema)


def alignment_report(
    docs: DataFrame, folder: str = TOKENIZERS, tokens: int = LANE_TOKENS, table_bytes: int = TABLE_BYTES
) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    n_best counts the links whose pair is, over all documents, the most frequent of its
    B id, ties included; count_sum adds up the links' counts. Texts are encoded and
    aligned once; what is kept of their links is packed and written. A task adds up its
    pairs before they are shuffled. The counts are looked up in blocks of `table_bytes`,
    one after the other over the packed links: usually one, and no more than the two
    vocabularies have pairs.
    """
    spark = docs.sparkSession
    rows = written(align(docs, folder, tokens), "aligned")
    counts = written(pair_counts(rows), "pair-counts")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1))
    best = np.zeros(1 << B_BITS, dtype=np.int64)
    for row in counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("n")).collect():
        best[row["b"]] = row["n"]  # a row for each id of B at most
    blocks = max(1, -(-counts.count() * PAIR_BYTES // table_bytes))
    zero = F.lit(0).cast("bigint")
    rows = rows.select("links", zero.alias("n_best"), zero.alias("count_sum"),
                       "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    for block in range(blocks):
        rows = _with_counts(spark, rows, counts.where(F.pmod("pair", F.lit(blocks)) == block), best)
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
