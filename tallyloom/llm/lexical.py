"""Ranked lexical search: one Aho-Corasick scan of the documents for all items' terms."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.storage import written
from tallyloom.llm.text import NO_ID

# Results an item.
MOST = 10
# Items are held by every task in blocks of about this many bytes.
BLOCK_BYTES = 4 * 1024 * 1024
# Scores that a task holds at once, documents times items.
SCORES_HELD = 1 << 18
# The ranks of a document set are taken in this many parts first.
PARTS = 256

# ASCII letters and digits, A-Z lower-cased, and all bytes of other characters stay;
# each other byte is a boundary.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def folded(text: str | None) -> bytes:
    return (text or "").encode().translate(FOLD)


class Automaton:
    """The terms of all items of a block, each with a boundary on either side.

    An occurrence leads to the term's number, and that to the items that have it.
    """

    def __init__(self, items: list[tuple]) -> None:
        numbers: dict[bytes, int] = {}
        held: list[list[tuple[int, int]]] = []
        for item, (_, text) in enumerate(items):
            for term, times in Counter(folded(text).split()).items():
                number = numbers.setdefault(term, len(numbers))
                if number == len(held):
                    held.append([])
                held[number].append((item, times))
        self.size = len(numbers)
        self.first = np.concatenate(([0], np.cumsum([len(x) for x in held]))).astype(np.int64)
        pairs = np.array([pair for x in held for pair in x], dtype=np.int64).reshape(-1, 2)
        self.items, self.times = pairs[:, 0], pairs[:, 1]
        self.search = ahocorasick.Automaton()
        for term, number in numbers.items():
            self.search.add_word(f" {term.decode('latin-1')} ", number)
        if numbers:
            self.search.make_automaton()

    def found(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The terms that a folded text has, and how often."""
        if not self.size:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        guarded = f" {text.decode('latin-1')} "
        hits = np.fromiter((number for _, number in self.search.iter(guarded)), np.int64)
        return np.unique(hits, return_counts=True)


def weight(documents: int, having: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * having + 1)))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column, and how many each row has."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values, column.value_lengths().to_numpy(zero_copy_only=False)


def _list_column(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(ends, values.astype(np.int32))


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    """Items with a text, in blocks that are small enough for every task to hold."""
    items = items.select("item_id", "text").where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).collect()[0][0]
    blocks = max(1, -(-total // block_bytes))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for block in range(blocks):
        yield [tuple(row) for row in items.where(number == block).collect()]


class _Best:
    """The best documents of each item so far, over the batches of a task."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.held = self.last = np.zeros((0, 3), dtype=np.int64)

    def add(self, items: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        rows = np.concatenate((self.held, np.stack((items, scores, ids), axis=1)))
        rows = rows[np.lexsort((rows[:, 2], -rows[:, 1], rows[:, 0]))]
        starts = np.flatnonzero(np.diff(rows[:, 0], prepend=-1))
        place = np.arange(len(rows)) - np.repeat(starts, np.diff(starts, append=len(rows)))
        self.held, self.last = rows[place < self.most], rows[place == self.most - 1]

    def least(self, items: int) -> np.ndarray:
        """The score that a further document of each item must reach."""
        least = np.ones(items, dtype=np.int64)
        least[self.last[:, 0]] = self.last[:, 1]
        return least


def _block_ranks(docs: DataFrame, items: list[tuple], block: int, most: int) -> DataFrame:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(items)
    ready: list[Automaton] = []

    def automaton() -> Automaton:
        if not ready:
            ready.append(Automaton(shared.value))
        return ready[0]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, terms, times = [], [], []
            for text in batch.column(1).to_pylist():
                text = folded(text)
                sizes.append(len(text.split()))
                found = automaton().found(text)
                terms.append(found[0])
                times.append(found[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), _list_column(terms), _list_column(times)],
                ["doc_id", "n", "terms", "times"],
            )

    scanned = written(
        docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
            scan, "doc_id bigint, n bigint, terms array<int>, times array<int>"
        ),
        "term-counts",
    )
    documents, length = scanned.agg(
        F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))
    ).collect()[0]

    def holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        having = np.zeros(automaton().size, dtype=np.int64)
        for batch in batches:
            having += np.bincount(_lists(batch.column(0))[0], minlength=len(having))
        some = np.flatnonzero(having)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(having[some])], ["term", "having"])

    # a row for each term of the block at most
    having = dict(
        tuple(row)
        for row in scanned.select("terms").mapInArrow(holders, "term bigint, having bigint")
        .groupBy("term").agg(F.sum("having")).collect()
    )

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = automaton()
        weights = np.array([weight(documents, having.get(t, 0)) for t in range(terms.size)], dtype=np.int64)
        count, best = len(shared.value), _Best(most)
        step = max(1, SCORES_HELD // max(count, 1))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                ids = batch.column(0).fill_null(NO_ID).to_numpy()
                share = [75 * n * documents // length if n else 0 for n in batch.column(1).to_pylist()]
                (term, lengths), (times, _) = _lists(batch.column(2)), _lists(batch.column(3))
                row = np.repeat(np.arange(len(ids)), lengths)
                m = 100 - 75 + np.array(share, dtype=np.int64)[row]
                times = times.astype(np.int64)
                parts = weights[term] * (1_000_000_000 * times // (1000 * times + 8 * m))
                lists = terms.first[term + 1] - terms.first[term]
                from_hit = np.repeat(np.arange(len(term)), lists)
                place = np.arange(len(from_hit)) - np.repeat(np.cumsum(lists) - lists, lists) + terms.first[term][from_hit]
                cell = row[from_hit] * count + terms.items[place]
                value = parts[from_hit] * terms.times[place]
                # sums of halves are exact in doubles
                low, high = (
                    np.bincount(cell, weights=half, minlength=len(ids) * count).astype(np.int64)
                    for half in (value & 0xFFFFFF, value >> 24)
                )
                scores = (low + (high << 24)).reshape(len(ids), count)
                r, item = np.nonzero(scores >= best.least(count)[None, :])
                best.add(item, scores[r, item], ids[r])
        held = best.held
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(held[:, 0]),
                pa.array([shared.value[i][0] for i in held[:, 0].tolist()], pa.int64()),
                pa.array(held[:, 2], mask=held[:, 2] == NO_ID),
                pa.array(held[:, 1]),
            ],
            ["item", "item_id", "doc_id", "score"],
        )

    return scanned.mapInArrow(
        rank, "item bigint, item_id bigint, doc_id bigint, score bigint"
    ).withColumn("block", F.lit(block))


def rank_documents(
    docs: DataFrame, items: DataFrame, most: int = MOST, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The `most` documents of highest score above 0 for each item: item_id, rank, doc_id, score.

    Terms are runs of letters and digits, in which every character beyond ASCII counts
    as a letter, A-Z lower-cased. A term's weight falls with the documents that have it;
    its frequency in a document saturates, the sooner the shorter the document is
    against the mean. Whole numbers but for the logarithm, so reruns agree.

    The automaton of all terms of all items goes to every task, and one scan of the
    texts counts the terms of each document; no index of the documents is made. Only
    these counts are scored. A task passes on its best rows for an item; they are ranked
    in parts and then together, so that no task sees more than a fixed number a part.

    Equal scores stand by ascending doc_id, null ids last. A null or empty text has no
    term and is in no result; a null or empty item has none. Repeated documents each
    take a rank; of equal items each has its ranks. Items beyond `block_bytes` are
    searched block by block, the texts read again for each.
    """
    found = reduce(
        DataFrame.unionByName,
        [_block_ranks(docs, block, n, most) for n, block in enumerate(_blocks(items, block_bytes))],
    )
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))
    in_part = Window.partitionBy("block", "item", part).orderBy(*order)
    whole = Window.partitionBy("block", "item").orderBy(*order)
    return (
        found.withColumn("rank", F.row_number().over(in_part))
        .where(F.col("rank") <= most)
        .withColumn("rank", F.row_number().over(whole))
        .where(F.col("rank") <= most)
        .select("item_id", "rank", "doc_id", "score")
    )
