"""Sharding by proportional stratified interleaving, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.ranks import running_totals
from tallyloom.llm.storage import written
from tallyloom.llm.text import distinct_rows, key_of, row_key, seeded


def assign_shards(docs: DataFrame, shards: int = 8, seed: int = 10) -> DataFrame:
    """Per document: doc_id, row_key, size, text_crc32, shard and slot.

    Within each source the rows are shuffled by a seeded hash and ranked. Sorted
    by fractional rank, (rank + 1/2) / rows of the source, all sources advance in
    proportion; the sequence is cut into `shards` stretches whose row counts are
    at most one apart, so that each has every source's share of the whole to
    within a row or two. `slot` is the place within the shard, from 0.

    `size` is the number of UTF-8 bytes of the text (0 for null) plus 1;
    `text_crc32` of a null text is that of an empty one. A null source is a source
    of its own, null ids share one place in the shuffle and go by their rows' values,
    repeated rows are separate rows; reruns agree. Equal texts are spread like any others, since a group of
    copies may be larger than a shard.
    """
    light = written(
        docs.select(
            "doc_id",
            row_key(docs).alias("row_key"),
            key_of(F.col("source")).alias("source_key"),
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
            F.crc32(F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))).alias("text_crc32"),
            seeded(seed, F.col("doc_id")).alias("place"),
            F.monotonically_increasing_id().alias("row_no"),
        ),
        "shard-rows",
    )
    counts = (
        light.groupBy("source_key")
        .agg(F.count("*").alias("in_source"))
        .withColumn("in_all", F.sum("in_source").over(Window.partitionBy()))
    )
    tie = ["place", "doc_id", "row_key", "row_no"]
    ranked = running_totals(light, ["source_key"], tie, F.lit(1), "rank")
    fractional = ranked.join(counts, "source_key").withColumn(
        "fraction", (2 * F.col("rank") + 1) / (2 * F.col("in_source"))
    )
    placed = running_totals(fractional, [], ["fraction", "source_key", *tie], F.lit(1), "at")
    shard = F.expr(f"at * {shards} div in_all")
    return placed.withColumn("shard", shard).select(
        "doc_id",
        "row_key",
        "size",
        "text_crc32",
        F.col("shard").cast("int").alias("shard"),
        F.expr(f"at - (shard * in_all + {shards - 1}) div {shards}").alias("slot"),
    )


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = 10) -> DataFrame:
    """The documents with shard and slot; a shard or slot column of theirs gives way.

    Narrow rows carry the assignment through its sorts; texts are shuffled once,
    when they meet it.
    """
    kept = [name for name in docs.columns if name not in ("shard", "slot")]
    assigned = assign_shards(docs, shards, seed).select("row_key", "shard", "slot")
    return (
        assigned.join(distinct_rows(docs), "row_key")
        .select(*[F.col("row").getField(name).alias(name) for name in kept], "shard", "slot")
    )


def write_shards(sharded: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """Parquet folders `shard=N`, each of `files_per_shard` files in slot order."""
    at_most = sharded.groupBy("shard").agg(F.max("slot").alias("last"))
    (
        sharded.join(at_most, "shard")
        .withColumn("_file", F.expr(f"slot * {files_per_shard} div (last + 1)"))
        .drop("last")
        .repartition("shard", "_file")
        .sortWithinPartitions("shard", "slot")
        .drop("_file")
        .write.partitionBy("shard")
        .mode("overwrite")
        .parquet(path)
    )
