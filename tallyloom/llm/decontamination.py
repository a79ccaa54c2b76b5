"""Benchmark decontamination by pigeonhole edit matching."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Errors allowed, as a share of an item's characters.
ERROR_RATE = 0.08
# Items are held by every task in blocks of about this many bytes.
BLOCK_BYTES = 16 * 1024 * 1024


class _Folded(dict):
    """Code point to its folded form, filled as characters are met."""

    def __missing__(self, code: int) -> str:
        char = chr(code).lower()
        self[code] = char if char.isalnum() else " "
        return self[code]


_FOLDED = _Folded()


def fold(text: str | None) -> str:
    """Lower case; whatever is neither letter nor digit becomes one space."""
    return " ".join((text or "").translate(_FOLDED).split())


def bounded(folded: str) -> str:
    """A folded text between spaces, so that items are met at word boundaries."""
    return f" {folded} " if folded else ""


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """The item cut into budget + 1 pieces, with their places.

    No more than `budget` errors can touch all of them, so one is met unchanged.
    """
    edges = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def masks_of(pattern: str) -> dict[str, int]:
    """For each character the places where the pattern has it, as bits."""
    where: dict[str, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << i
    return where


def nearest(
    where: dict[str, int], size: int, text: str, start: int, stop: int, *, back: bool = False
) -> tuple[int, int]:
    """The least edit distance of a pattern to a stretch of the text, and where that ends.

    The stretch may begin anywhere from `start` on and ends by `stop`, at the first place
    of several. With `back` it is read from `stop` to `start`, has to begin at `stop`, and
    `where` is of the reversed pattern. Myers' bit vectors: a column of the distance
    matrix in two whole numbers, a few operations for each character.
    """
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = full, 0, size
    best, at = size, stop if back else start
    grown = 1 if back else 0
    for j in range(stop - 1, start - 1, -1) if back else range(start, stop):
        match = where.get(text[j], 0)
        x = match | minus
        d = (((match & plus) + plus) ^ plus) | match
        up, down = minus | ~(d | plus) & full, plus & d
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1 | grown) & full, (down << 1) & full
        plus, minus = down | ~(x | up) & full, up & x
        if score < best:
            best, at = score, j if back else j + 1
    return best, at


class Items:
    """Benchmark items ready for search in folded texts."""

    def __init__(self, items: list[tuple], error_rate: float) -> None:
        self.items: list[tuple] = []
        self.masks: list[tuple[dict[str, int], dict[str, int]]] = []
        places: dict[str, dict[int, tuple[int, int]]] = {}
        for item_id, text in items:
            folded = fold(text)
            if not folded:
                continue
            budget = int(len(folded) * error_rate)
            number, item = len(self.items), bounded(folded)
            self.items.append((item_id, len(item), budget))
            self.masks.append((masks_of(item), masks_of(item[::-1])))
            for at, piece in pieces(item, budget):
                own = places.setdefault(piece, {})
                own[number] = (own.get(number, (at,))[0], at)
        self.search = ahocorasick.Automaton()
        for piece, own in places.items():
            self.search.add_word(
                piece, [(number, len(piece), *ends) for number, ends in own.items()]
            )
        if places:
            self.search.make_automaton()

    def matches(self, text: str | None) -> dict[int, tuple[int, int, int]]:
        """By item number: the least distance with start and end in the folded text.

        A hit says where the item would start, give or take its budget. Hits of an item
        that may belong together make one window, and each window is read once, so that
        text that repeats itself costs no more than its length.
        """
        best: dict[int, tuple[int, int, int]] = {}
        if not self.items:
            return best
        whole = bounded(fold(text))
        windows: dict[int, list[list[int]]] = {}
        for end, found in self.search.iter(whole):
            for number, size, first, last in found:
                _, length, budget = self.items[number]
                start = end - size + 1
                low, high = start - last - budget, start - first + length + budget
                own = windows.setdefault(number, [])
                while own and own[-1][1] >= low:
                    before = own.pop()
                    low, high = min(low, before[0]), max(high, before[1])
                own.append([low, high])
        for number, own in windows.items():
            _, length, budget = self.items[number]
            onward, back = self.masks[number]
            least, at = budget + 1, 0
            for low, high in own:
                found = nearest(onward, length, whole, max(low, 0), min(high, len(whole)))
                if found[0] < least:
                    least, at = found
            if least <= budget:
                reach = max(0, at - length - least)
                start = nearest(back, length, whole, reach, at, back=True)[1]
                # without the spaces around the item
                best[number] = (least, start, max(start, at - 2))
        return best


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    """The items in blocks that are small enough for every task to hold."""
    items = benchmark.select("item_id", "text").where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).collect()[0][0]
    blocks = max(1, -(-total // block_bytes))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for block in range(blocks):
        yield [tuple(row) for row in items.where(number == block).collect()]


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    error_rate: float = ERROR_RATE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """A row for each document and item that it holds with few enough errors.

    doc_id, item_id, distance, budget, and start and end in the folded text of the
    nearest place. An item's budget is its folded length times `error_rate`,
    rounded down. All its pieces are looked for in the whole text at once; the windows
    around exact hits are verified. Items are met at word boundaries: "cat" isn't in
    "concatenate", though a boundary may be one of an item's errors.

    Null and empty texts hold nothing; null and empty items, and such without a
    letter or digit, are held by nothing. A row repeated gives its rows again; of
    equal item rows each gives its own. A benchmark larger than `block_bytes` is
    searched block by block: the texts are read again for each, nothing is left out.
    """
    spark = docs.sparkSession

    def search(block: list[tuple]) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)
        ready: list[Items] = []

        def hits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            if not ready:
                ready.append(Items(shared.value, error_rate))
            for frame in frames:
                rows = [
                    (doc_id, *ready[0].items[n][::2], distance, start, end)
                    for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True)
                    for n, (distance, start, end) in ready[0].matches(text).items()
                ]
                yield pd.DataFrame(
                    rows, columns=["doc_id", "item_id", "budget", "distance", "start", "end"]
                ).astype({"doc_id": "Int64", "item_id": "Int64"})

        return docs.select("doc_id", "text").mapInPandas(
            hits, "doc_id bigint, item_id bigint, budget int, distance int, start int, end int"
        )

    return reduce(DataFrame.unionByName, map(search, _blocks(benchmark, block_bytes)))


def without_items(
    docs: DataFrame,
    benchmark: DataFrame,
    error_rate: float = ERROR_RATE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents that hold no item. Columns as they came; texts aren't moved."""
    spark = docs.sparkSession
    for block in _blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(block)
        docs = docs.where(~_holds(shared, error_rate)("text"))
    return docs


def _holds(shared, error_rate: float):
    ready: list[Items] = []

    @F.pandas_udf("boolean")
    def holds(texts: pd.Series) -> pd.Series:
        if not ready:
            ready.append(Items(shared.value, error_rate))
        return pd.Series([bool(ready[0].matches(text)) for text in texts], dtype=bool)

    return holds
