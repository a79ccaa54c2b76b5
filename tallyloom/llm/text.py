"""What the operators share about texts: words, row identity, group keys."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space that separates words, as patterns for the JVM
# and for Python's text and bytes.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
WORD_BYTES = re.compile(WORD.encode())
SPACE_BYTES = b" \t\n\x0b\x0c\r"

# Stands for a missing doc_id where a key must not be null; sorts after all ids.
NO_ID = 2**63 - 1


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda word: word != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def text_key(text: Column) -> Column:
    """64 bits that stand for a text; null has its own value."""
    return F.xxhash64(text.isNull(), text)


def key_of(column: Column) -> Column:
    """A text column as a key that is never null and sorts nulls last."""
    return F.when(column.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), column))


def seeded(seed: int, column: Column) -> Column:
    """A pseudo-random text that depends on the seed and the value only."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(column.cast("string"), F.lit("null"))))


def row_key(rows: DataFrame) -> Column:
    """128 bits, as text, that stand for a whole row; maps count by their entries as they stand."""
    parts = []
    for field in rows.schema.fields:
        c = F.col(f"`{field.name}`")
        if "map<" in field.dataType.simpleString():
            c = F.to_json(F.struct(c.alias("x")))
        parts += [c.isNull(), c]
    # a struct's fields may be null once it is read back, which costs joins a shuffle
    return F.concat_ws(":", F.hex(F.xxhash64(*parts)), F.hex(F.xxhash64(F.lit("low"), *parts)))


def distinct_rows(rows: DataFrame) -> DataFrame:
    """row_key and the row as a struct, once for rows that are equal throughout.

    Each task keeps one of its equal rows before the shuffle.
    """
    whole = F.struct(*[F.col(f"`{name}`") for name in rows.columns])
    return (
        rows.select(row_key(rows).alias("row_key"), whole.alias("row"))
        .groupBy("row_key")
        .agg(F.any_value("row").alias("row"))
    )
