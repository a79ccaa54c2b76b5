from __future__ import annotations

import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Rows of the documents table from (doc_id, text) or (doc_id, text, source)."""

    def build(*rows, extra: str = ""):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), *r[3:]) for r in rows
        ]
        return spark.createDataFrame(full, COLUMNS + extra)

    return build


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
