"""The stored fact: loads in sequence, entered in a ledger.

The rows of a load lie under ``data/LOAD_ID=.../YEAR=.../MONTH=...`` and are never
changed. ``ledger`` holds a numbered file for each load, created after its rows: what it
doesn't name isn't there. A load takes the place of an earlier one of its name, a history
load that of all before it. Earlier rows stay, so that the fact can be read as of any load.
"""

from __future__ import annotations

import json
import re
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.names import all_quoted, quoted
from tallyloom.sources.files import create_once, hours_since, names_in, read_text, remove
from tallyloom.sources.schemas import STORED_SALES
from tallyloom.sources.session import shuffles_go
from tallyloom.sources.sinks import held

# Column that tells loads apart; also the outermost directory of the fact.
LOAD_ID = "LOAD_ID"
HISTORY = "history"
LEDGER, DATA = "ledger", "data"


class Entry(NamedTuple):
    """A load as the ledger has it. `digest` stands for its rows in any order."""

    number: int
    load: str
    load_id: str
    digest: str
    rows: int
    replaces_all: bool


class RepeatedLoad(ValueError):
    """The rows of a load are there already under another name."""


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """The ledger, oldest load first: a small file for each load ever made."""
    folder = f"{path}/{LEDGER}"
    return [
        Entry(number=int(name), **json.loads(read_text(spark, f"{folder}/{name}")))
        for name in names_in(spark, folder)
    ]


def live(ledger: list[Entry], as_of: int | None = None) -> list[Entry]:
    """The loads that make up the fact, at present or right after load number `as_of`."""
    found: dict[str, Entry] = {}
    for entry in ledger:
        if as_of is not None and entry.number > as_of:
            break
        if entry.replaces_all:
            found.clear()
        found[entry.load] = entry
    return list(found.values())


def content_digest(df: DataFrame) -> tuple[str, int]:
    """A text that stands for the rows of `df` in any order, and their number.

    Two sums of 64-bit row hashes and the count; equal rows count as often as they occur.
    A task adds up the halves of its hashes as integers, which takes a fraction of what
    decimals do; only the sums of tasks are decimals.
    """
    parts = [part for name in sorted(df.columns) for part in (F.col(quoted(name)).isNull(), F.col(quoted(name)))]
    halves, wholes = [], []
    for seed in ("a", "b"):
        digest = F.xxhash64(F.lit(seed), *parts)
        for half, bits in ((f"{seed}_high", F.shiftright(digest, 32)), (f"{seed}_low", digest.bitwiseAND(0xFFFFFFFF))):
            halves.append(F.sum(bits).alias(half))
            wholes.append(F.coalesce(F.sum(F.col(half).cast("decimal(38,0)")), F.lit(0)).alias(half))
    of_tasks = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), *halves)
    row = of_tasks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *wholes).first()
    sums = (int(row[f"{seed}_high"]) * 2**32 + int(row[f"{seed}_low"]) for seed in ("a", "b"))
    return ":".join(map(str, (row["n"], *sums))), row["n"]


def _by_month(df: DataFrame) -> DataFrame:
    """Gather each month's rows into few files of even size, in the order of products.

    Rebalancing lets the runtime split a busy month over many tasks and put
    quiet months together, instead of one file per month and task. Within a file the
    products are in order, so that a few of them lie in few row groups.
    """
    return df.hint("rebalance", "YEAR", "MONTH").sortWithinPartitions("YEAR", "MONTH", "ISBN")


def _refused(present: list[Entry], load: str, digest: str, rows: int) -> Entry | None:
    """The load that has these rows already; under another name they raise `RepeatedLoad`."""
    same = next((entry for entry in present if entry.digest == digest and entry.rows), None)
    if same and same.load != load:
        raise RepeatedLoad(f"{load} has the {rows} rows of {same.load}")
    return same


def write_load(df: DataFrame, path: str, load: str, *, replaces_all: bool = False) -> Entry:
    """Add a load to the fact, or put it in the place of the one of its name.

    Rows of the same months from other loads (late corrections, history) stay, and
    months a corrected file no longer has go. The same rows once more under the same name
    change nothing; under another name they are refused with `RepeatedLoad`.

    A load whose name is there is most likely a rerun. Its rows are stored as they
    come and compared, and gathered by month only if they differ.
    """
    if not re.fullmatch(r"[A-Za-z0-9_-]+", load):
        raise ValueError(f"a load name has letters, digits, - and _ only: {load!r}")
    spark = df.sparkSession
    present = [] if replaces_all else live(entries(spark, path))
    if any(entry.load == load for entry in present):
        with held(df, "rerun") as staged:
            return _refused(present, load, *content_digest(staged)) or _add_load(staged, path, load)
    return _add_load(df, path, load, replaces_all)


def _add_load(df: DataFrame, path: str, load: str, replaces_all: bool = False) -> Entry:
    spark, load_id = df.sparkSession, f"load-{uuid.uuid4().hex}"
    folder = f"{path}/{DATA}/{LOAD_ID}={load_id}"
    with shuffles_go(spark):
        (
            _by_month(df)
            .write.partitionBy("YEAR", "MONTH")
            .option("compression", "zstd")
            .option("parquet.bloom.filter.enabled#ISBN", "true")
            # as small as a file's products allow, instead of 1 MB for each file
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .parquet(folder)
        )
    digest, rows = content_digest(spark.read.schema(df.schema).parquet(folder))
    while True:
        ledger = entries(spark, path)
        if not replaces_all:
            try:
                same = _refused(live(ledger), load, digest, rows)
            except RepeatedLoad:
                remove(spark, folder)
                raise
            if same:
                remove(spark, folder)
                return same
        number = ledger[-1].number + 1 if ledger else 1
        entry = Entry(number, load, load_id, digest, rows, replaces_all)
        fields = {name: value for name, value in entry._asdict().items() if name != "number"}
        if create_once(spark, f"{path}/{LEDGER}", f"{number:012d}", json.dumps(fields)):
            return entry


def replace_history(df: DataFrame, path: str) -> Entry:
    """Put one history load in the place of all loads."""
    return write_load(df, path, HISTORY, replaces_all=True)


def read_loads(
    spark: SparkSession,
    path: str,
    schema: T.StructType = STORED_SALES,
    *,
    as_of: int | None = None,
    load_ids: list[str] | None = None,
) -> DataFrame:
    """The fact over its loads, at present or as of a load number, or of given loads only.

    Loads, YEAR and MONTH prune directories.
    """
    if load_ids is None:
        load_ids = [entry.load_id for entry in live(entries(spark, path), as_of)]
    if not load_ids:
        return spark.createDataFrame([], schema)
    whole = T.StructType([*schema.fields, T.StructField(LOAD_ID, T.StringType())])
    df = spark.read.schema(whole).parquet(f"{path}/{DATA}")
    return df.filter(F.col(LOAD_ID).isin(load_ids)).select(*all_quoted(schema.names))


def sweep(spark: SparkSession, path: str, hours: float = 48) -> list[str]:
    """Delete rows of loads that never came into the ledger; returns their ids.

    They are what failed writes left behind. `hours` is how long nothing must have changed
    in them, longer than any write takes.
    """
    known = {entry.load_id for entry in entries(spark, path)}
    gone = []
    for name in names_in(spark, f"{path}/{DATA}"):
        load_id = name.removeprefix(f"{LOAD_ID}=")
        if load_id not in known and hours_since(spark, f"{path}/{DATA}/{name}") >= hours:
            remove(spark, f"{path}/{DATA}/{name}")
            gone.append(load_id)
    return gone
