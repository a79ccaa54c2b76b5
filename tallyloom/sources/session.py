"""Session set-up and the shared folder for written intermediates."""

from __future__ import annotations

import re
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Fixed values. AQE merges small shuffle partitions and splits skewed ones, so
# the partition count below is only the ceiling it starts from.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


# A shuffle partition of this size is sorted and aggregated in memory.
PARTITION_BYTES = 512 * 1024 * 1024


def partitions_for(shuffle_bytes: int) -> int:
    """Shuffle partitions for an expected shuffle, at least 200."""
    return max(200, -(-shuffle_bytes // PARTITION_BYTES))


def build_session(
    app: str = "tallyloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    shuffle_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings the reports are tuned for.

    `master` is for local runs; on a cluster it comes from the submit command.
    `shuffle_partitions` is the count a shuffle starts with, or follows from the
    bytes of the largest shuffle expected; the runtime merges what turns out too
    small.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(SESSION_CONF)
    if shuffle_bytes:
        settings["spark.sql.shuffle.partitions"] = str(partitions_for(shuffle_bytes))
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Removes a query's shuffle files when it ends, on whatever executor they lie.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _blocks, _before = threading.Lock(), Counter(), {}


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Queries that end in this block leave no shuffle files.

    They would stay until the driver happens to collect its garbage. The setting is the session's:
    of blocks in several threads the first sets it and the last puts it back.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        if not _blocks[session]:
            _before[session] = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _blocks[session] += 1
    try:
        yield
    finally:
        with _lock:
            _blocks[session] -= 1
            if not _blocks[session]:
                before = _before.pop(session)
                del _blocks[session]
                spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor can reach.

    It lies under ``spark.checkpoint.dir``, which a cluster has to set. Where it is unset
    a local session, whose executors are the driver, has it under the warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[(?!.*-cluster)|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediates"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
