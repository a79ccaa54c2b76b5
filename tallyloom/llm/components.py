"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.storage import written


def _state(pairs: DataFrame) -> tuple:
    return tuple(
        pairs.agg(
            F.count("*"), F.sum(F.xxhash64("above", "root").cast("decimal(38,0)"))
        ).collect()[0]
    )


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node and root, the least node of its component; nodes without a link are absent.

    Each round hangs every neighbour of a node on the least of them: first the
    neighbours above the node, then those below. The least neighbour is a
    minimum, combined before the shuffle, so a node with very many links isn't
    gathered anywhere; the join that follows has one row a node on one side and
    can be split on the other. The rounds grow with the logarithm of the number of
    nodes, each writes its pairs to shared storage, and the last, in which every
    node hangs on its root, changes nothing.
    """
    pairs = written(
        links.select(
            F.greatest(a, b).alias("above"), F.least(a, b).alias("root")
        ).where("above != root").distinct(),
        "links",
    )
    state = _state(pairs)
    while state[0]:
        both = pairs.select(F.col("above").alias("u"), F.col("root").alias("v")).unionByName(
            pairs.select(F.col("root").alias("u"), F.col("above").alias("v"))
        )
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v")  # a pair may repeat until the round's end
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), "m")
        pairs = written(
            small.unionByName(least)
            .select(F.greatest("u", "m").alias("above"), F.least("u", "m").alias("root"))
            .where("above != root")
            .distinct(),
            "stars",
        )
        before, state = state, _state(pairs)
        if state == before:
            break
    return pairs.select(F.col("above").alias("node"), "root").unionByName(
        pairs.select(F.col("root").alias("node"), "root").distinct()
    )
