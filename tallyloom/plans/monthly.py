"""Monthly sums of the stored facts, before any map is met.

A load's sums are made once, when a refresh first meets the load, and stored beside the
fact; a correction or a new month costs the rows of its own load. All reports of a refresh
read the sums. Maps change between refreshes, so they are met afterwards, by accounts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.names import all_quoted, quoted
from tallyloom.functions.numbers import whole
from tallyloom.functions.text import strip_hyphens
from tallyloom.operators.cleaning import conform
from tallyloom.sources.loads import entries, live, read_loads
from tallyloom.sources.published import publish, version_folder, versions
from tallyloom.sources.schemas import MONEY, STORED_SALES, STORED_SALES_S

# Amounts cut to whole units before they are added up, and their sizes: the target report
# takes each sale so, see `scale_targets`.
WHOLE, SIZE = "WHOLE_AMT", "SIZE"

# What tells the sums of a month apart, by channel.
KEYS_A = ["ISBN", "TITLE", "NAMECUST", "HQ Account Number", "SL Account Number", "YEAR", "MONTH"]
KEYS_S = ["NEWBILLTO", "ISBN", "TITLE", "NAMECUST", "YEAR", "MONTH"]


class Shape:
    """A channel's stored fact, its keys and the schema of its sums."""

    def __init__(self, fact: T.StructType, keys: list[str]) -> None:
        self.fact, self.keys = fact, keys
        self.sums = T.StructType(
            [
                *(fact[key] for key in keys),
                T.StructField("NETUNITS", T.LongType()),
                T.StructField("NETAMT", MONEY),
                T.StructField(WHOLE, T.LongType()),
                T.StructField(SIZE, T.LongType()),
            ]
        )


SHAPE_A, SHAPE_S = Shape(STORED_SALES, KEYS_A), Shape(STORED_SALES_S, KEYS_S)


def monthly_sums(stored: DataFrame, shape: Shape) -> DataFrame:
    """Sums by month at the finest grain that the reports share.

    Texts are stripped and hyphens taken out of the product key first, so that sales
    which the reports take for one are one row.
    """
    facts = conform(stored, shape.fact).withColumn("ISBN", strip_hyphens(F.col("ISBN")))
    amount = whole(F.col("NETAMT"))
    return (
        facts.groupBy(*all_quoted(shape.keys))
        .agg(
            F.sum("NETUNITS").alias("NETUNITS"),
            F.sum("NETAMT").cast(MONEY).alias("NETAMT"),
            F.sum(amount).alias(WHOLE),
            F.sum(F.abs(amount)).alias(SIZE),
        )
        .select(*all_quoted(shape.sums.names))
    )


def keep_sums(
    spark: SparkSession, facts: str, sums: str, shape: Shape, as_of: int | None = None
) -> list[str]:
    """Store the sums of each load of a fact that has none yet; returns those loads' ids.

    Of the loads that make up the fact, at present or as of a load number; nothing else of
    it is read. A load never changes, so its sums are final.
    """
    new = []
    for entry in live(entries(spark, facts), as_of):
        load_id = entry.load_id
        if versions(spark, f"{sums}/{load_id}"):
            continue
        new.append(load_id)
        load = read_loads(spark, facts, shape.fact, load_ids=[load_id])
        ordered = monthly_sums(load, shape).sortWithinPartitions("YEAR", "MONTH", "ISBN")
        publish(ordered, f"{sums}/{load_id}")
    return new


def read_sums(
    spark: SparkSession, facts: str, sums: str, shape: Shape, as_of: int | None = None
) -> DataFrame:
    """The stored sums of the loads that make up a fact, at present or as of a load number."""
    ids = [entry.load_id for entry in live(entries(spark, facts), as_of)]
    if not ids:
        return spark.createDataFrame([], shape.sums)
    folders = [version_folder(spark, f"{sums}/{load_id}") for load_id in ids]
    return spark.read.schema(shape.sums).parquet(*folders)


def accounts_of(sums: DataFrame, shape: Shape) -> DataFrame:
    """The accounts and customer names that occur in sums, once each."""
    keys = [key for key in shape.keys if key not in ("ISBN", "TITLE", "YEAR", "MONTH")]
    return sums.select(*(F.col(quoted(key)) for key in keys)).distinct()
