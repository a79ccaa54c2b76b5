"""Small marker files, through the file system that Spark has for their path."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def create_once(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """A file with this text, in full or not at all; False if there is one of that name.

    It is written under a hidden name and then renamed, which fails where the name is
    taken: of two writers one succeeds, and no reader sees half a file.
    """
    system, hidden = _system(spark, folder), f"{folder}/.{name}-{uuid.uuid4().hex}"
    out = system.create(_path(spark, hidden), False)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.getUri(), spark._jsc.hadoopConfiguration()
    )
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        context.rename(
            system.makeQualified(_path(spark, hidden)),
            system.makeQualified(_path(spark, f"{folder}/{name}")),
            spark._sc._gateway.new_array(rename, 0),
        )
    except Exception:
        system.delete(_path(spark, hidden), False)
        if not system.exists(_path(spark, f"{folder}/{name}")):
            raise
        return False
    return True


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """The names of a folder in order, hidden ones left out; none if there is no folder."""
    system = _system(spark, folder)
    if not system.exists(_path(spark, folder)):
        return []
    names = [status.getPath().getName() for status in system.listStatus(_path(spark, folder))]
    return sorted(name for name in names if name[0] not in "._")


def hours_since(spark: SparkSession, path: str) -> float:
    """How long ago anything directly in a folder, or the folder, was last changed."""
    system, place = _system(spark, path), _path(spark, path)
    times = [system.getFileStatus(place).getModificationTime()]
    times += [status.getModificationTime() for status in system.listStatus(place)]
    return (time.time() - max(times) / 1000) / 3600


def read_text(spark: SparkSession, path: str) -> str:
    """The whole of a small file."""
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)
