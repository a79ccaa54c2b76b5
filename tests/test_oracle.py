"""Every registered query against its SQL in DuckDB, over whole tables."""

from __future__ import annotations

import os

import pytest

from tests.comparison import connect, differences
from workload.catalog import QUERIES
from workload.oracle import ORACLE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, name):
    assert not differences(QUERIES[name](spark, SF_DIR), con, ORACLE[name])
