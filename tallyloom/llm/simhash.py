"""Near-duplicates by SimHash fingerprints and pivot distance tables."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.components import connected_components
from tallyloom.llm.storage import written
from tallyloom.llm.text import WORD_BYTES, row_key, text_key

SEED = 42
SHINGLE = 4
MOST_BITS = 4
PIVOTS = 16
# Fixed by 64 - 48 bits: no bucket of the finest tables can hold more fingerprints.
MOST_IN_BUCKET = 1 << 16
FINEST = 16


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """A hash for each run of `shingle` words; a shorter text is one run."""
    words = WORD_BYTES.findall((text or "").encode().lower())
    if not words:
        return np.zeros(0, dtype="<u8")
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    size = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts.tolist(), ends[size - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype="<u8", count=len(starts))


def fingerprint(text: str | None) -> int:
    """64 bits, each set if it is set in over half the shingle hashes."""
    hashes = shingle_hashes(text, SHINGLE)
    if not len(hashes):
        return 0
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        block = hashes[at : at + 4096].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and fingerprint (as a signed number) of each row."""

    @F.pandas_udf("bigint")
    def of_texts(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(text) for text in texts], dtype="int64")

    return docs.select(
        "doc_id", text_key(F.col("text")).alias("text_key"), of_texts("text").alias("fingerprint")
    )


def bands_for(fingerprints: int) -> int:
    """How many bands the 64 bits are cut into.

    Fingerprints with at most 4 differing bits agree in all bands but 4 at most,
    so they meet in one of the tables keyed by all bands but 4. More bands make
    longer keys in more tables; the least number is taken at which a key still
    has four times as many values as there are fingerprints.
    """
    for bands in range(MOST_BITS + 2, FINEST):
        if fingerprints * 4 <= 1 << (64 * (bands - MOST_BITS) // bands):
            return bands
    return FINEST


def masks(bands: int) -> list[int]:
    """For each table the bits of its key, as signed numbers."""
    edges = [64 * i // bands for i in range(bands + 1)]
    parts = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:], strict=False)]
    chosen = [sum(c) for c in combinations(parts, bands - MOST_BITS)]
    return [mask - (1 << 64) if mask >> 63 else mask for mask in chosen]


def pivots() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 64, PIVOTS, dtype=np.uint64)


def distance_table(fingerprints: np.ndarray) -> np.ndarray:
    """Hamming distances to the pivots, a row a fingerprint."""
    return np.bitwise_count(fingerprints[:, None] ^ pivots()[None, :]).astype(np.int8)


def bucket_links(members: np.ndarray, table: np.ndarray) -> list[tuple[int, int]]:
    """Links that span each group of a bucket: its first member to every other.

    A member is compared with those that no group has taken yet. Two fingerprints
    can't be nearer than the difference of their distances to any pivot, so one
    column of the table after the other thins out the candidates before the rest
    are verified. Each member is expanded once; what is linked already is never
    compared again, so a bucket of near copies costs little more than its size.
    """
    links, left = [], np.arange(1, len(members))
    first, queue = 0, [0]
    while queue or len(left):
        if not queue:
            first, left = int(left[0]), left[1:]
            queue = [first]
        at = queue.pop()
        near = left
        for column in range(table.shape[1]):
            if not len(near):
                break
            near = near[np.abs(table[near, column] - table[at, column]) <= MOST_BITS]
        if len(near):
            near = near[np.bitwise_count(members[near] ^ members[at]) <= MOST_BITS]
        if len(near):
            links.extend((first, int(other)) for other in near)
            queue.extend(near.tolist())
            left = left[~np.isin(left, near, assume_unique=True)]
    return links


def _link_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by table and key, in; links and what is too many for a bucket, out.

    Out come rows (a, b): a linked pair, or a fingerprint and null if its bucket
    holds more than `MOST_IN_BUCKET`. No more than that is ever kept.
    """
    held: list[np.ndarray] = []
    held_key, held_size, over = None, 0, False

    def flush() -> tuple[np.ndarray, np.ndarray, bool]:
        members = np.concatenate(held) if held else np.zeros(0, np.uint64)
        if over:
            return members, np.zeros(0, np.uint64), True
        if len(members) < 2:
            return members[:0], members[:0], False
        links = np.array(bucket_links(members, distance_table(members)), dtype=np.int64)
        links = links.reshape(-1, 2)
        return members[links[:, 0]], members[links[:, 1]], False

    def batch(a: list[np.ndarray], b: list[np.ndarray], missing: list[np.ndarray]) -> pa.RecordBatch:
        a, b, missing = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b, missing))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(a.astype(np.uint64).view(np.int64)),
                pa.array(b.astype(np.uint64).view(np.int64), mask=missing.astype(bool)),
            ],
            ["a", "b"],
        )

    def add(out: tuple, found: tuple[np.ndarray, np.ndarray, bool]) -> None:
        a, b, alone = found
        if len(a):
            out[0].append(a)
            out[1].append(a if alone else b)
            out[2].append(np.full(len(a), alone))

    for rows in batches:
        if not rows.num_rows:
            continue
        keys = np.stack([rows.column(0).to_numpy().astype(np.int64), rows.column(1).to_numpy()], axis=1)
        prints = rows.column(2).to_numpy().view(np.uint64)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        starts = np.concatenate(([0], cuts))
        stops = np.concatenate((cuts, [len(prints)]))
        out: tuple = ([], [], [])
        for i, (start, stop) in enumerate(zip(starts.tolist(), stops.tolist(), strict=True)):
            if i and stop - start == 1 and stop < len(prints):
                if held_size:
                    add(out, flush())
                    held, held_size, over = [], 0, False
                held_key = None
                continue
            key = tuple(keys[start])
            if key != held_key:
                if held_size:
                    add(out, flush())
                held, held_size, held_key, over = [], 0, key, False
            held.append(prints[start:stop])
            held_size += stop - start
            if over or held_size > MOST_IN_BUCKET:
                over = True
                add(out, flush())
                held = []
        if out[0]:
            yield batch(*out)
    if held_size and held:
        out = ([], [], [])
        add(out, flush())
        if out[0]:
            yield batch(*out)


def _tables(prints: DataFrame, bands: int) -> DataFrame:
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("t"),
                F.col("fingerprint").bitwiseAND(F.lit(mask)).alias("k"),
            )
            for i, mask in enumerate(masks(bands))
        ]
    )
    return (
        prints.select(F.explode(rows).alias("x"), "fingerprint")
        .select("x.t", "x.k", "fingerprint")
        .repartition("t", "k")
        .sortWithinPartitions("t", "k")
        .mapInArrow(_link_buckets, "a bigint, b bigint")
    )


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints of at most 4 differing bits.

    Every pair so near meets in a bucket, and is joined there directly or over
    others: no link is lost, though not every pair gets a row. Buckets that are
    larger than the finest tables allow are dealt again by those tables.
    """
    bands = bands_for(prints.count())
    found = written(_tables(prints, bands), "near")
    links = found.where("b is not null")
    if bands < FINEST and not found.where("b is null").isEmpty():
        crowded = found.where("b is null").select(F.col("a").alias("fingerprint")).distinct()
        links = links.unionByName(written(_tables(crowded, FINEST), "near").where("b is not null"))
    return links


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text_key, fingerprint, root, component_id.

    Texts are cut into 4-word shingles, A-Z lower-cased; a shorter text is one
    shingle; a text without words, or null, has fingerprint 0 and is linked like
    any other. Fingerprints of at most 4 differing bits are linked, directly or
    over others. `root` names the component, `component_id` is its least doc_id;
    null ids count only where a component has no other, then it is null. Repeated
    rows get a row each; other columns are ignored. Copies share a fingerprint and
    are never compared with each other.
    """
    rows = written(with_fingerprints(docs), "fingerprints")
    per_print = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    links = fingerprint_links(per_print.select("fingerprint"))
    roots = connected_components(links, "a", "b").withColumnRenamed("node", "fingerprint")
    labelled = per_print.join(roots, "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    # Stored, so that the join reads both sides from a shuffle and can split a hot root.
    least = written(labelled.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    named = labelled.join(least, "root").select("fingerprint", "root", "component_id")
    return rows.join(named, "fingerprint").select(
        "doc_id", "text_key", "fingerprint", "root", "component_id"
    )


def hex_of(fingerprint: str):
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component: that of the least doc_id, nulls last.

    Among rows of one doc_id the text with the least key stays. Columns as they
    came.
    """
    return one_of_each(docs, near_duplicates(docs))


def one_of_each(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """The row of each root that has the least doc_id, from doc_id, text_key and root."""
    chosen = (
        labelled.groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("best"))
        .select(
            F.coalesce("best.doc_id", F.lit(0)).alias("_d"),
            F.col("best.doc_id").isNull().alias("_n"),
            F.col("best.text_key").alias("_t"),
        )
    )
    # Each task keeps one of its rows of a document before texts move.
    one_each = (
        docs.select(
            F.coalesce("doc_id", F.lit(0)).alias("_d"),
            F.col("doc_id").isNull().alias("_n"),
            text_key(F.col("text")).alias("_t"),
            row_key(docs).alias("row_key"),
            F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        )
        .groupBy("_d", "_n", "_t")
        .agg(F.min_by("row", "row_key").alias("row"))
    )
    return one_each.join(chosen, ["_d", "_n", "_t"], "left_semi").select("row.*")
