from __future__ import annotations

import pytest

from tallyloom.sources.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        app="tests",
        master="local[8]",
        shuffle_partitions=4,
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "1000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def facts(spark):
    """Build sales rows from (ISBN, TITLE, NAMECUST, category, period, units, amount)."""

    def build(*rows):
        return spark.createDataFrame(
            [
                (isbn, title, name, category, period // 100, period % 100, units, float(amount))
                for isbn, title, name, category, period, units, amount in rows
            ],
            "ISBN string, TITLE string, NAMECUST string, SALES_CATEGORY string,"
            " YEAR int, MONTH int, NETUNITS bigint, NETAMT double",
        ).selectExpr("* except (NETAMT)", "cast(NETAMT as decimal(18,4)) as NETAMT")

    return build
