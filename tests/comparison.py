"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


# Spark type to the type DuckDB reports for the same column.
SAME_TYPE = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def differences(df, con, sql: str) -> list[str]:
    """What differs, as short texts; empty if nothing does."""
    cursor = con.execute(sql)
    expected_names = [column[0] for column in cursor.description]
    expected = rows_of(expected_names, cursor.fetchall())
    theirs = {column[0]: str(column[1]) for column in cursor.description}
    found = [
        f"type of {name}: {kind} != {theirs[name]}"
        for name, kind in df.dtypes
        if name in theirs and SAME_TYPE.get(kind) != theirs[name]
    ]
    actual = rows_of(df.columns, [tuple(row) for row in df.collect()])
    if sorted(df.columns) != sorted(expected_names):
        found.append(f"columns {sorted(df.columns)} != {sorted(expected_names)}")
    if actual.total() != expected.total():
        found.append(f"rows {actual.total()} != {expected.total()}")
    if actual != expected:
        found.append(f"only in Spark {list((actual - expected).items())[:2]}")
        found.append(f"only in DuckDB {list((expected - actual).items())[:2]}")
    return found
