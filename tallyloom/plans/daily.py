"""The daily refresh: reload the maps, then write both two-channel reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tallyloom.functions.names import all_quoted
from tallyloom.operators.cleaning import look_back
from tallyloom.plans.channels import mapped_a, mapped_s
from tallyloom.plans.combined import report_combined
from tallyloom.plans.monthly import SHAPE_A, SHAPE_S, keep_sums, monthly_sums, read_sums
from tallyloom.plans.targets import report_targets
from tallyloom.sources.published import read_published
from tallyloom.sources.schemas import CATEGORY_MAP_A, CATEGORY_MAP_S, NAME_MAP
from tallyloom.sources.sinks import (
    Stored,
    replace_if_any,
    replace_table,
    replace_with_totals,
    written,
)

MAPS = {
    "CATEGORY_MAP_A": CATEGORY_MAP_A,
    "CATEGORY_MAP_S": CATEGORY_MAP_S,
    "NAME_MAP": NAME_MAP,
}
# The columns of each report whose sums its write reports.
TOTALS = {
    "COMBINED_SALES_REPORT": ["12M_UNITS", "12M_DOLLARS", "YTD_UNITS", "YTD_DOLLARS"],
    "TARGET_REPORT": ["12M_ROLLING_ACTUAL", "YTD_ACTUAL", "YTD_TARGET"],
}


def load_maps(spark: SparkSession, maps: dict[str, DataFrame], out: str) -> dict[str, DataFrame]:
    """Store the reference maps and return them as stored.

    An empty name map leaves the stored one as it is.
    """
    for name, schema in MAPS.items():
        chosen = maps[name].select(*all_quoted(schema.names))
        path = f"{out}/{name}"
        if name == "NAME_MAP":
            replace_if_any(chosen, path)
        else:
            replace_table(chosen, path)
    return {name: read_published(spark, f"{out}/{name}", schema) for name, schema in MAPS.items()}


def refresh_reports(
    spark: SparkSession,
    sums_a: DataFrame,
    sums_s: DataFrame,
    maps: dict[str, DataFrame],
    targets: DataFrame,
    products: DataFrame,
    locations: DataFrame,
    out: str,
    as_of: date,
    target_year: int,
    *,
    rollup: DataFrame | None = None,
    without: str | None = None,
) -> dict[str, Stored]:
    """Write the maps and both reports under `out`, from stored monthly sums.

    Returns for each report its folder and the totals that its write saw. A report
    is replaced as a whole: whoever reads it meanwhile keeps the earlier one.
    """
    stored = load_maps(spark, maps, out)
    sales_a = mapped_a(look_back(sums_a, as_of), stored["CATEGORY_MAP_A"], stored["NAME_MAP"])
    sales_s = mapped_s(look_back(sums_s, as_of), stored["CATEGORY_MAP_S"], without=without)
    reports = {
        "COMBINED_SALES_REPORT": report_combined(sales_a, sales_s, rollup, products, as_of),
        "TARGET_REPORT": report_targets(
            sales_a, sales_s, targets, locations, as_of, target_year
        ),
    }
    return {
        name: replace_with_totals(df, f"{out}/{name}", TOTALS[name])
        for name, df in reports.items()
    }


def daily_refresh(
    spark: SparkSession,
    stored_a: DataFrame,
    stored_s: DataFrame,
    maps: dict[str, DataFrame],
    targets: DataFrame,
    products: DataFrame,
    locations: DataFrame,
    out: str,
    as_of: date,
    target_year: int,
    *,
    rollup: DataFrame | None = None,
    without: str | None = None,
) -> dict[str, Stored]:
    """`refresh_reports` from stored facts, each of which is read once.

    The sums of the look-back window serve both reports.
    """
    sums_a, sums_s = (
        written(monthly_sums(look_back(stored, as_of), shape), "sums")
        for stored, shape in ((stored_a, SHAPE_A), (stored_s, SHAPE_S))
    )
    return refresh_reports(
        spark, sums_a, sums_s, maps, targets, products, locations, out, as_of, target_year,
        rollup=rollup, without=without,
    )


def refresh_from_loads(
    spark: SparkSession,
    facts_a: str,
    facts_s: str,
    sums: str,
    maps: dict[str, DataFrame],
    targets: DataFrame,
    products: DataFrame,
    locations: DataFrame,
    out: str,
    as_of: date,
    target_year: int,
    *,
    rollup: DataFrame | None = None,
    without: str | None = None,
    as_of_loads: tuple[int | None, int | None] = (None, None),
) -> dict[str, Stored]:
    """`refresh_reports` from facts that are kept by load.

    Only loads that no refresh has met before are read; of all others the sums under
    `sums` are there. With `as_of_loads`, the load numbers of either fact to go back to,
    the reports are those of that time.
    """
    read = []
    for facts, name, shape, number in (
        (facts_a, "a", SHAPE_A, as_of_loads[0]),
        (facts_s, "s", SHAPE_S, as_of_loads[1]),
    ):
        keep_sums(spark, facts, f"{sums}/{name}", shape, number)
        read.append(read_sums(spark, facts, f"{sums}/{name}", shape, number))
    return refresh_reports(
        spark, *read, maps, targets, products, locations, out, as_of, target_year,
        rollup=rollup, without=without,
    )
