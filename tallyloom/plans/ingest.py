"""From raw distributor files to the stored fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.names import all_quoted, quoted
from tallyloom.functions.numbers import or_zero, raw_date, round_half_even
from tallyloom.functions.text import is_invalid_isbn, repair_isbn, strip
from tallyloom.operators.cleaning import conform, rename, strip_strings
from tallyloom.operators.lookups import fill_from, missing_from
from tallyloom.sources.schemas import CATEGORY_MAP_A, MONEY, STORED_SALES

# Columns of the raw file that are not kept, and the new names of
# those that are.
DROPPED = [
    "SL ST", "Free Units", "Return Credit", "Gross Invc", "Return Units", "Sold Units", "DC",
    "SL City", "Shipping Location", "Order Date",
]
RENAMED = {
    "Net Sold Units": "NETUNITS",
    "Net Invc": "NETAMT",
    "EAN": "ISBN",
    "Title": "TITLE",
    "Headquarter": "NAMECUST",
}
KEYS = [
    "ISBN", "YEAR", "MONTH", "TITLE", "NAMECUST", "IPS Sale",
    "HQ Account Number", "SL Account Number",
]
# A number of the product key, by which rows lie where their title was found.
PLACE = "_place"
ACCOUNT_PAIR = ["SL Account Number", "HQ Account Number"]


def clean_rows(raw: DataFrame, titles: DataFrame, *, repair: bool = False) -> DataFrame:
    """Raw rows in the shape of the stored fact, not yet grouped; see `placed_rows`."""
    return placed_rows(raw, titles, repair=repair).drop(PLACE)


def placed_rows(raw: DataFrame, titles: DataFrame, *, repair: bool = False) -> DataFrame:
    """Raw rows in the shape of the stored fact, and `PLACE`.

    Units are rounded half to even per row. A date that cannot be read leaves
    YEAR and MONTH null. `repair` restores product keys a spreadsheet turned
    into numbers, before they are used to look up missing titles.
    """
    rows = rename(strip_strings(raw.drop(*DROPPED)), RENAMED)
    if repair:
        rows = rows.withColumn("ISBN", repair_isbn(F.col("ISBN")))
    # A column of its own, so that a date text is examined once for both parts.
    rows = rows.withColumn("_day", raw_date(F.col("Date"))).withColumns(
        {
            "YEAR": F.year("_day"),
            "MONTH": F.month("_day"),
            "NETUNITS": or_zero(round_half_even(F.col("NETUNITS"))),
            "NETAMT": or_zero(F.col("NETAMT").cast(MONEY)),
        }
    ).select(*all_quoted(STORED_SALES.names))
    names = titles.select(
        strip(F.col("Z_ID").cast("string")).alias("Z_ID"),
        strip(F.col("LONG_TITLE")).alias("LONG_TITLE"),
    )
    # Rows move for their title in the shape they are stored in.
    rows = fill_from(rows, names, {"ISBN": "Z_ID"}, "TITLE", "LONG_TITLE", place=PLACE)
    return rows.select(*all_quoted([*STORED_SALES.names, PLACE]))


def group_rows(rows: DataFrame) -> DataFrame:
    """One row per key; rows with any part of the key missing are left out.

    The class is a text, whose minimum can't be hash-aggregated. Sums by key and
    class are, and the minimum is taken over their rows. `PLACE` follows from the product
    key; with it rows that moved to find their title needn't move again for either sum.
    """
    of_class = "SL Class of Trade"
    keys = [*KEYS, PLACE] if PLACE in rows.columns else KEYS
    return (
        rows.dropna(subset=KEYS)
        .groupBy(*all_quoted([*keys, of_class]))
        .agg(F.sum("NETUNITS").alias("NETUNITS"), F.sum("NETAMT").alias("NETAMT"))
        .groupBy(*all_quoted(keys))
        .agg(
            F.sum("NETUNITS").alias("NETUNITS"),
            F.sum("NETAMT").cast(MONEY).alias("NETAMT"),
            F.min(of_class).alias(of_class),
        )
        .select(*all_quoted(STORED_SALES.names))
    )


def ingest_month(raw: DataFrame, titles: DataFrame) -> DataFrame:
    """The grouped rows of a monthly file, ready for `write_load`."""
    return group_rows(placed_rows(raw, titles))


def reload_history(raw: DataFrame, titles: DataFrame) -> DataFrame:
    """The grouped rows of a history file, ready for `replace_history`."""
    return group_rows(placed_rows(raw, titles, repair=True))


def unmapped_accounts(raw: DataFrame, categories: DataFrame) -> DataFrame:
    """Account pairs the category map does not know, with their raw row counts.

    Ingest stores no category, so this is all the map is needed for.
    """
    rows = raw.select(*(strip(F.col(quoted(name))).alias(name) for name in ACCOUNT_PAIR))
    known = conform(categories, CATEGORY_MAP_A).filter(
        F.col("`MASTER SALES CATEGORY`").isNotNull()
    )
    return missing_from(rows, known, {name: name for name in ACCOUNT_PAIR})


def ingest_checks(rows: DataFrame, set_aside: DataFrame | None = None) -> DataFrame:
    """What grouping does to cleaned rows, from a single pass over them.

    `rows` comes from `clean_rows`. Dropped rows are those without a full key. Lines that
    the reader set aside are counted as well, if they are given.
    """
    complete = F.lit(True)
    for key in KEYS:
        complete = complete & F.col(quoted(key)).isNotNull()
    amount = F.col("NETAMT")
    nothing = F.lit(0)
    checks = {
        "N_ROWS": F.count(F.lit(1)),
        "UNITS": or_zero(F.sum("NETUNITS")),
        "AMOUNT": or_zero(F.sum(amount)),
        "DROPPED_ROWS": F.count_if(~complete),
        "DROPPED_UNITS": F.coalesce(F.sum(F.when(~complete, F.col("NETUNITS"))), nothing),
        "DROPPED_AMOUNT": F.coalesce(F.sum(F.when(~complete, amount)), nothing),
        "INVALID_ISBN_ROWS": F.count_if(is_invalid_isbn(F.col("ISBN"))),
    }

    def tall(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
        wide = df.agg(*(c.cast("decimal(38,4)").alias(name) for name, c in columns.items()))
        return wide.unpivot([], list(columns), "CHECK_NAME", "VALUE")

    found = tall(rows, checks)
    if set_aside is not None:
        found = found.unionByName(tall(set_aside, {"UNREADABLE_LINES": F.count(F.lit(1))}))
    return found
