"""Dropping lines that an earlier document has, with keep bitmaps for results."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.storage import written
from tallyloom.llm.text import NO_ID, SPACE_BYTES, text_key

LEAST_CHARS = 10

# Kinds of the rows that a sorted partition gives.
DROP, OPEN, LAST = 0, 1, 2


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE_BYTES).lower()


def counts_as_key(key: bytes, least_chars: int) -> bool:
    if len(key) < least_chars:
        return False
    return len(key) >= 4 * least_chars or len(key.decode()) >= least_chars


def _line_keys(docs: DataFrame, least_chars: int) -> DataFrame:
    """A row for each key of a text: its 128-bit hash, the document, its lines' places."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids, texts, high, low, doc, of_text, at = rows.column(0), rows.column(1), [], [], [], [], []
            lines = [(text or "").encode().split(b"\n") for text in rows.column(2).to_pylist()]
            for i, (d, t) in enumerate(zip(ids.to_pylist(), texts.to_pylist(), strict=True)):
                places: dict[bytes, list[int]] = {}
                for n, line in enumerate(lines[i]):
                    key = line_key(line)
                    if counts_as_key(key, least_chars):
                        places.setdefault(xxhash.xxh3_128_digest(key), []).append(n)
                high.extend(places)
                at.extend(places.values())
                doc.extend([d] * len(places))
                of_text.extend([t] * len(places))
            both = np.frombuffer(b"".join(high), dtype=">i8").astype(np.int64).reshape(-1, 2)
            high, low = both[:, 0], both[:, 1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(high),
                    pa.array(low),
                    pa.array(doc, pa.int64()),
                    pa.array(of_text, pa.int64()),
                    pa.array(at, pa.list_(pa.int32())),
                ],
                ["h1", "h2", "did", "text_key", "at"],
            )

    return docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("did"), text_key(F.col("text")).alias("t"), "text"
    ).mapInArrow(keys, "h1 bigint, h2 bigint, did bigint, text_key bigint, at array<int>")


def _first_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams a partition sorted by key and document; only the running key is kept.

    A row whose document isn't the first of its key is dropped. For the key that
    opens the partition an earlier one may have the first: its rows come out as
    OPEN, to be settled later. The key that closes the partition comes out as LAST
    with its first document here.
    """
    opening = running = first = None
    for rows in batches:
        if not rows.num_rows:
            continue
        h = np.stack([rows.column(0).to_numpy(), rows.column(1).to_numpy()], axis=1)
        did = rows.column(2).to_numpy()
        starts = np.concatenate(([0], np.flatnonzero((h[1:] != h[:-1]).any(axis=1)) + 1))
        group = np.zeros(len(did), dtype=np.int64)
        group[starts[1:]] = 1
        firsts = did[starts].copy()
        if opening is None:
            opening = tuple(h[0])
        if running == tuple(h[0]):
            firsts[0] = first
        is_open = (h == np.array(opening)).all(axis=1)
        first_of_row = firsts[np.cumsum(group)]
        kind = np.where(is_open, OPEN, DROP)
        running, first = tuple(h[-1]), first_of_row[-1]
        wanted = np.flatnonzero(is_open | (did != first_of_row))
        if len(wanted):
            out = rows.take(pa.array(wanted))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind[wanted].astype(np.int32)), *out.columns],
                ["kind", "h1", "h2", "did", "text_key", "at"],
            )
    if running is not None:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([LAST], pa.int32()),
                pa.array([running[0]], pa.int64()),
                pa.array([running[1]], pa.int64()),
                pa.array([first], pa.int64()),
                pa.array([0], pa.int64()),
                pa.array([None], pa.list_(pa.int32())),
            ],
            ["kind", "h1", "h2", "did", "text_key", "at"],
        )


def keep_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """did, text_key and keep for each text that loses a line.

    A key is a line without the white space at its ends, A-Z lower-cased. Keys of
    at least `least_chars` code points stay only in the least doc_id that has
    them, there in all their places. `keep` has a bit a line up to the last that
    is dropped, packed and deflated; lines beyond stay. A text that loses nothing
    has no row.

    Hashes are range-partitioned together with the document, so a line that very
    many documents share lies in many partitions. Each streams its rows in the
    order of hash, document and place. What one partition can't know, the first
    document of a key that began before it, is settled from a row a partition.

    Rows of one doc_id are one document; `did` stands for it, and rows without an
    id are together one document after all others. Null text: one empty line.
    """
    streamed = written(
        _line_keys(docs, least_chars)
        .repartitionByRange("h1", "h2", "did", "text_key")
        .sortWithinPartitions("h1", "h2", "did", "text_key")
        .mapInArrow(
            _first_occurrences,
            "kind int, h1 bigint, h2 bigint, did bigint, text_key bigint, at array<int>",
        ),
        "line-drops",
    )
    first = (
        streamed.where(F.col("kind") != DROP)
        .groupBy("h1", "h2")
        .agg(F.min("did").alias("first"), F.max(F.col("kind") == OPEN).alias("opens"))
        .where("opens")
        .drop("opens")
    )
    settled = (
        streamed.where(F.col("kind") == OPEN)
        .join(F.broadcast(first), ["h1", "h2"])  # at most a row a partition
        .where(F.col("did") != F.col("first"))
        .select("did", "text_key", "at")
    )

    @F.pandas_udf("binary")
    def packed(places: pd.Series) -> pd.Series:
        return pd.Series([_pack(np.concatenate(list(lists))) for lists in places])

    return (
        streamed.where(F.col("kind") == DROP)
        .select("did", "text_key", "at")
        .unionByName(settled)
        .distinct()
        .groupBy("did", "text_key")
        .agg(F.collect_list("at").alias("places"))
        .select("did", "text_key", packed("places").alias("keep"))
    )


def _pack(dropped: np.ndarray) -> bytes:
    keep = np.ones((int(dropped.max()) // 8 + 1) * 8, dtype=bool)  # whole bytes
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes())


def kept_lines(text: str | None, keep: bytes | None) -> tuple[list[str], int]:
    """The lines that stay, and how many there were."""
    lines = (text or "").split("\n")
    if keep is None:
        return lines, len(lines)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))
    dropped = set(np.flatnonzero(bits[: len(lines)] == 0).tolist())
    return [line for n, line in enumerate(lines) if n not in dropped], len(lines)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped and the text that stays."""

    @F.pandas_udf("n_lines bigint, n_dropped bigint, text string")
    def kept(texts: pd.Series, keeps: pd.Series) -> pd.DataFrame:
        found = [kept_lines(text, keep) for text, keep in zip(texts, keeps, strict=True)]
        return pd.DataFrame(
            {
                "n_lines": [n for _, n in found],
                "n_dropped": [n - len(lines) for lines, n in found],
                "text": ["\n".join(lines) for lines, _ in found],
            }
        )

    return (
        docs.select(
            "doc_id",
            "text",
            F.coalesce("doc_id", F.lit(NO_ID)).alias("did"),
            text_key(F.col("text")).alias("text_key"),
        )
        .join(bitmaps, ["did", "text_key"], "left")
        .select("doc_id", kept("text", "keep").alias("k"))
        .select("doc_id", "k.*")
    )


def digest(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped and the SHA-256 of what stays."""
    return apply_bitmaps(docs, keep_bitmaps(docs, least_chars)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256")
    )
