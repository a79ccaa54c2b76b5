"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.ranks import running_totals
from tallyloom.llm.storage import written
from tallyloom.llm.text import distinct_rows, key_of, row_key, seeded, word_count

# Expected copies are whole numbers of this unit, so that prefix sums are exact.
UNIT = 1 << 30


def source_targets(
    sizes: DataFrame, weights: Sequence[int], share_percent: int, most_copies: int
) -> DataFrame:
    """Per source: source_key, source_size and target.

    Sources in the order of their keys take the weights in turn. They share
    `share_percent` of all sizes by weight; a target stops at `most_copies` times
    the size of its source, and what is left over is shared by weight among the
    others until none is above. Filling the sources in the order of limit by
    weight finds that in one pass over a row for each source.
    """
    by_key = Window.orderBy("source_key")
    by_limit = Window.orderBy(F.col("room") / F.col("weight"), "source_key")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    turn = (F.row_number().over(by_key) - 1) % len(weights)
    return (
        sizes.groupBy("source_key")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.get(F.array(*map(F.lit, weights)), turn).cast("bigint"))
        .withColumn("room", F.col("source_size") * most_copies)
        .withColumn("shared", F.sum("source_size").over(everything) * share_percent)
        .withColumn("used", F.coalesce(F.sum("room").over(before), F.lit(0)))
        .withColumn("claims", F.sum("weight").over(onward))
        .withColumn(
            "full",
            F.col("room") * 100 * F.col("claims")
            <= (F.col("shared") - F.col("used") * 100) * F.col("weight"),
        )
        .withColumn("used", F.sum(F.when(F.col("full"), F.col("room")).otherwise(0)).over(everything))
        .withColumn(
            "claims", F.sum(F.when(F.col("full"), F.lit(0)).otherwise(F.col("weight"))).over(everything)
        )
        .select(
            "source_key",
            "source_size",
            F.when(F.col("full"), F.col("room").cast("double"))
            .otherwise(
                (F.col("weight") * (F.col("shared") - F.col("used") * 100)).cast("double")
                / (F.col("claims") * 100)
            )
            .alias("target"),
        )
    )


def plan_mix(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share_percent: int = 150,
    most_copies: int = 2,
    seed: int = 5,
) -> DataFrame:
    """Per document: doc_id, row_key, size, source_size, target and copies.

    Each source's documents stand in the order of size, then pseudo-random, rows of one
    id by their values; rows that tie throughout are equal, so reruns agree. Their
    expected copies, target over source size, are summed from the front; one
    random offset for each source is added, and a document is emitted once for
    each whole number that its stretch crosses. As the order goes by size, the
    words taken miss a target by about the size of the largest document only.

    A null text has size 0, a null source is a source of its own, after the
    others. A source without words has target 0. Repeated rows are documents of
    their own. An empty table gives an empty plan.
    """
    sizes = written(
        docs.select(
            "doc_id",
            key_of(F.col("source")).alias("source_key"),
            row_key(docs).alias("row_key"),
            word_count(F.col("text")).alias("size"),
            seeded(seed, F.col("doc_id")).alias("place"),
            F.monotonically_increasing_id().alias("row_no"),
        ),
        "mix-sizes",
    )
    targets = source_targets(sizes, weights, share_percent, most_copies)
    offset = F.conv(F.substring(seeded(seed, F.col("source_key")), 1, 7), 16, 10).cast("bigint") * 4
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rated = sizes.join(
        targets.withColumn("units", F.floor(rate * UNIT)).withColumn("offset", offset), "source_key"
    )
    summed = running_totals(
        rated,
        ["source_key"],
        ["size", "place", "doc_id", "row_key", "row_no"],
        F.col("units").cast("decimal(38,0)"),
        "front",
    )
    return summed.select(
        "doc_id",
        "row_key",
        "size",
        "source_size",
        "target",
        F.expr(
            f"(front + units + offset) div {UNIT}L - (front + offset) div {UNIT}L"
        ).alias("copies"),
    )


def mix(docs: DataFrame, **parameters) -> DataFrame:
    """The mix itself: every document as often as the plan says, all columns kept.

    Copies are planned on narrow rows. Equal rows are gathered on either side
    before texts meet their plan, so that a row repeated very often joins once.
    """
    copies = (
        plan_mix(docs, **parameters)
        .groupBy("row_key")
        .agg(F.sum("copies").cast("int").alias("copies"))
        .where("copies > 0")
    )
    return (
        distinct_rows(docs)
        .join(copies, "row_key")
        .select(F.explode(F.sequence(F.lit(1), "copies")), "row")
        .select("row.*")
    )
