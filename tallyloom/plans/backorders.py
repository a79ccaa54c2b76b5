"""Open backorders of both channels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import strip
from tallyloom.operators.checks import union_all


def combine_backorders(raw_a: DataFrame, backorders_s: DataFrame) -> DataFrame:
    """Backordered units per title and product.

    Channel A lists titles without backorders too; those go. Rows without a
    title or product are dropped. One grouping over both channels: Spark adds
    up each side before the shuffle anyway.
    """
    of_a = raw_a.filter(F.col("Open Backorder") != 0).select(
        strip(F.col("Title")).alias("TITLE"),
        strip(F.col("EAN")).alias("ISBN"),
        F.col("Open Backorder").cast("bigint").alias("QTY"),
    )
    of_s = backorders_s.select(
        strip(F.col("TITLE")).alias("TITLE"),
        strip(F.col("ITEMNO")).alias("ISBN"),
        F.col("QTYREC").cast("bigint").alias("QTY"),
    )
    return (
        union_all([of_a, of_s])
        .dropna(subset=["TITLE", "ISBN"])
        .groupBy("TITLE", "ISBN")
        .agg(F.coalesce(F.sum("QTY"), F.lit(0)).alias("QTY"))
    )
