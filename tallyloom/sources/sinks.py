"""Writes: reports and maps, each replaced as a whole, and intermediates."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import DataFrame

from tallyloom.operators.checks import observe_totals
from tallyloom.sources.files import remove
from tallyloom.sources.published import publish
from tallyloom.sources.session import shared_folder, shuffles_go


class Stored(NamedTuple):
    """Where a table was written, and what the write saw: N_ROWS and sums of columns."""

    path: str
    totals: dict[str, Decimal | int]


def replace_table(df: DataFrame, path: str) -> str:
    """Replace a stored relation; returns the folder of what was written."""
    return publish(df, path)


def replace_with_totals(df: DataFrame, path: str, columns: Sequence[str]) -> Stored:
    """Replace a stored relation; the write itself counts its rows and adds up `columns`."""
    watched, seen = observe_totals(df, f"totals of {path}", columns)
    return Stored(publish(watched, path), dict(seen.get))


def replace_if_any(df: DataFrame, path: str) -> bool:
    """Replace a reference map unless the new one is empty."""
    if df.isEmpty():
        return False
    publish(df, path)
    return True


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows, cut from their lineage by a write to the shared folder.

    Later stages read files that every executor sees, so a lost executor costs its
    own tasks only, and a plan that is used twice runs once. The files go when the
    driver's JVM ends.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def held(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """The rows as from :func:`written`, for a block of code at whose end the files go.

    What was shuffled for them goes as soon as they are written.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    try:
        with shuffles_go(spark):
            df.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)
