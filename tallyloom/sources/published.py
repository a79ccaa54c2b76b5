"""Stored tables that are replaced as a whole or not at all.

A table is a folder. Each version of it lies in a folder of its own inside, and
``versions`` holds a numbered file for each, which names that folder and is created last.
A write that fails leaves the earlier version as it is; a reader goes on with the one it
began with.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyloom.functions.names import all_quoted
from tallyloom.sources.files import create_once, names_in, read_text, remove

VERSIONS = "versions"


def publish(df: DataFrame, path: str) -> str:
    """Replace a table; returns the folder of the new version. `df` may read the old one."""
    spark, name = df.sparkSession, f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{name}")
    while True:
        number = max(versions(spark, path), default=0) + 1
        if create_once(spark, f"{path}/{VERSIONS}", f"{number:012d}", name):
            return f"{path}/{name}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of a table's versions, oldest first."""
    return [int(name) for name in names_in(spark, f"{path}/{VERSIONS}")]


def version_folder(spark: SparkSession, path: str, version: int | None = None) -> str:
    """The folder of a version, of the latest without one."""
    there = versions(spark, path)
    if not there or version is not None and version not in there:
        raise FileNotFoundError(f"{path} has no version {version or ''}")
    return f"{path}/{read_text(spark, f'{path}/{VERSIONS}/{version or there[-1]:012d}')}"


def read_published(
    spark: SparkSession, path: str, schema: T.StructType, version: int | None = None
) -> DataFrame:
    """A table as last published, or as of a version, pruned to the declared columns."""
    df = spark.read.schema(schema).parquet(version_folder(spark, path, version))
    return df.select(*all_quoted(schema.names))


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all versions but the last `keep`; returns their numbers.

    Readers that began with one of them fail, so `keep` is for how long a reader takes.
    """
    if keep < 1:
        raise ValueError("the current version stays")
    old = versions(spark, path)[:-keep]
    for number in old:
        folder = version_folder(spark, path, number)
        remove(spark, f"{path}/{VERSIONS}/{number:012d}")
        remove(spark, folder)
    return old
