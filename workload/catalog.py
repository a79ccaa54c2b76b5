"""Queries over the test tables, one per operator and per report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tallyloom as tl
from tallyloom.functions.numbers import percent
from tallyloom.functions.text import is_invalid_isbn, mark_shared, repair_isbn, strip_hyphens
from tallyloom.operators import checks, cleaning, lookups, matrix
from tallyloom.operators import targets as target_ops
from tallyloom.plans import channels, combined, daily, distributor, ingest, monthly, targets, titles
from tallyloom.sources import loads, published, readers, schemas, sinks
from tallyloom.sources.session import shared_folder
from workload import relations as rel
from workload.relations import AS_OF, TARGET_YEAR

Query = Callable[[SparkSession, str], DataFrame]
UNITS, DOLLARS = "NETUNITS", "NETAMT"


def lookback_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = cleaning.look_back(rel.both_channels(spark, sf_dir), AS_OF)
    return facts.select("ISBN", "NAMECUST", "YEAR", "MONTH", UNITS)


def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column as text, names with white space, January units unreadable."""
    text = rel.both_channels(spark, sf_dir).select(
        "ISBN",
        F.concat(F.lit("\t "), "TITLE", F.lit("\n")).alias("TITLE"),
        F.concat(F.lit(" "), "NAMECUST", F.lit(" ")).alias("NAMECUST"),
        F.col("YEAR").cast("string").alias("YEAR"),
        F.col("MONTH").cast("string").alias("MONTH"),
        F.when(F.col("MONTH") == 1, "n/a").otherwise(F.col(UNITS).cast("string")).alias(UNITS),
        F.col(DOLLARS).cast("string").alias(DOLLARS),
        "SALES_CATEGORY",
    )
    tidy = cleaning.with_period(cleaning.conform(text, schemas.SALES, dirty=True))
    return matrix.money_as_double(tidy)


def union_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = combined.facts_of(
        rel.channel_a(spark, sf_dir, None), rel.channel_s(spark, sf_dir, None)
    )
    grouped = both.groupBy("YEAR", "MONTH", *combined.KEYS).agg(
        F.sum(UNITS).alias(UNITS), F.sum(DOLLARS).alias(DOLLARS)
    )
    return matrix.money_as_double(grouped)


def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.both_channels(spark, sf_dir).select(*combined.KEYS).distinct()


def _matrix(
    spark: SparkSession, sf_dir: str, keys: list[str], buckets: list[matrix.Bucket], **options
) -> DataFrame:
    facts = rel.both_channels(spark, sf_dir)
    return matrix.money_as_double(matrix.period_matrix(facts, keys, buckets, AS_OF, **options))


def ytd(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {UNITS: "YTD_UNITS", DOLLARS: "YTD_DOLLARS"}
    return _matrix(spark, sf_dir, ["ISBN", "TITLE"], matrix.ytd(AS_OF, columns))


def months_12(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = matrix.monthly(AS_OF, UNITS, "NET_UNITS_{mon}_{yyyy}")
    return _matrix(spark, sf_dir, ["NAMECUST", "SALES_CATEGORY"], buckets)


def trailing_12m(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {UNITS: "12M_UNITS", DOLLARS: "12M_DOLLARS"}
    buckets = matrix.trailing(AS_OF, 12, columns)
    return _matrix(spark, sf_dir, ["NAMECUST", "SALES_CATEGORY"], buckets)


def trailing_4m(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {UNITS: "4M_UNITS", DOLLARS: "4M_DOLLARS"}
    buckets = matrix.trailing(AS_OF, 4, columns)
    return _matrix(spark, sf_dir, ["ISBN", "TITLE"], buckets)


def prior_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = matrix.yearly(AS_OF, UNITS, "UNITS_{yyyy}")
    return _matrix(spark, sf_dir, ["ISBN", "SALES_CATEGORY"], buckets)


def period_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matrix(spark, sf_dir, combined.KEYS, combined.buckets(AS_OF))


def period_matrix_null_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matrix(spark, sf_dir, combined.KEYS, combined.buckets(AS_OF), null_keys="zero")


def coarse_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = rel.both_channels(spark, sf_dir)
    own = {UNITS: "12M_UNITS", DOLLARS: "12M_DOLLARS"}
    report = sinks.written(
        matrix.period_matrix(facts, combined.KEYS, matrix.trailing(AS_OF, 12, own), AS_OF), "matrix"
    )
    columns = {"12M_UNITS": "ALL_ACCTS_12M_UNITS", "12M_DOLLARS": "ALL_ACCTS_12M_DOLLARS"}
    everyone = matrix.coarse_totals(report, ["ISBN", "TITLE"], columns)
    joined = lookups.lookup(
        report, everyone, ["ISBN", "TITLE"], unique=True, measured=False, null_safe=True
    )
    return matrix.money_as_double(cleaning.fill_nulls(joined, zero=list(columns.values())))


def category_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = rel.stored_sales_a(spark, sf_dir, None).select(
        "ISBN", "SL Account Number", "HQ Account Number", UNITS
    )
    return distributor.add_category(facts, rel.category_map_a(spark, sf_dir))


def name_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = rel.stored_sales_a(spark, sf_dir, None).select("NAMECUST", UNITS)
    mapped = lookups.map_names(facts, rel.name_map(spark, sf_dir))
    return mapped.groupBy("NAMECUST").agg(F.sum(UNITS).alias(UNITS))


def exclude_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = rel.stored_sales_s(spark, sf_dir, None).select("NAMECUST", UNITS)
    kept = cleaning.exclude_customer(facts, "Customer#0000000%")
    return kept.groupBy("NAMECUST").agg(F.sum(UNITS).alias(UNITS))


def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = rel.table(spark, sf_dir, "part").select("p_name", "p_brand", "p_type", "p_size")
    return lookups.first_by_key(part, ["p_name"])


def dedupe_first_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same choice as it is made for a big table."""
    part = rel.table(spark, sf_dir, "part").select("p_name", "p_brand", "p_type", "p_size")
    return lookups.first_by_key_hashed(part, ["p_name"])


def skewed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of sales by a table taken for too big to broadcast, a third of the sales in one key."""
    facts = rel.both_channels(spark, sf_dir).select(
        F.when(F.col("MONTH") % 3 == 0, F.lit("1")).otherwise(F.col("ISBN")).alias("ISBN"), UNITS
    )
    titles_of = rel.products(spark, sf_dir).select("ISBN", "TITLE", "SUB_PUB")
    found = lookups.lookup(facts, rel.with_null_rows(titles_of, ["ISBN"]), ["ISBN"], limit=0)
    return found.groupBy("ISBN", "TITLE", "SUB_PUB").agg(F.sum(UNITS).alias(UNITS))


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.duplicate_keys(rel.table(spark, sf_dir, "part"), ["p_name"])


def first_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = rel.stored_sales_a(spark, sf_dir, None)
    return matrix.period_matrix(
        facts,
        ["ISBN", "NAMECUST"],
        matrix.trailing(AS_OF, 12, {UNITS: "12M_UNITS"}),
        AS_OF,
        smallest={"SALES_CLASS": "SL Class of Trade"},
    )


def title_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.strip_strings(rel.raw_sales(spark, sf_dir).select("EAN", "Title"))
    filled = lookups.fill_from(
        rows, rel.raw_titles(spark, sf_dir), {"EAN": "Z_ID"}, "Title", "LONG_TITLE"
    )
    return filled.groupBy("EAN", "Title").agg(F.count(F.lit(1)).alias("N_ROWS"))


def product_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = rel.both_channels(spark, sf_dir)
    sums = matrix.period_matrix(
        facts, ["ISBN"], matrix.trailing(AS_OF, 12, {UNITS: "12M_UNITS"}), AS_OF
    )
    products = combined.product_columns(rel.products(spark, sf_dir))
    return cleaning.fill_nulls(
        lookups.lookup(sums, products, ["ISBN"]),
        empty=["TYPE", "PROD", "SUB", "SEAS", "WEBCAT2", "WEBCAT2_DESCR"],
    )


def normalize_key_regroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("l_partkey").cast("string")
    hyphened = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("978-"), key, F.lit("-0")))
    return (
        rel.table(spark, sf_dir, "lineitem")
        .select(
            strip_hyphens(
                F.coalesce(hyphened, F.concat(F.lit("978"), key, F.lit("0")))
            ).alias("ISBN"),
            F.col("l_quantity").cast("bigint").alias(UNITS),
        )
        .groupBy("ISBN")
        .agg(F.sum(UNITS).alias(UNITS))
    )


def repair_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.format_string("%013d", "p_partkey")
    spoilt = (
        F.when(F.col("p_size") % 3 == 0, F.concat(key, F.lit(".0")))
        .when(F.col("p_size") % 3 == 1, F.concat(F.lit("9.78"), "p_partkey", F.lit("E+12")))
        .when(F.col("p_size") > 40, None)
        .otherwise(key)
    )
    parts = rel.table(spark, sf_dir, "part").select("p_partkey", repair_isbn(spoilt).alias("ISBN"))
    return parts.withColumn("IS_INVALID", is_invalid_isbn(F.col("ISBN")))


def product_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = cleaning.look_back(rel.stored_sales_a(spark, sf_dir, None), AS_OF, years=0)
    products = rel.products(spark, sf_dir).select("ISBN", "TITLE", "PROD_TYPE")
    return lookups.restrict_to(products, sold, ["ISBN"])


def active_only_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = rel.book_level_sales(spark, sf_dir, None)
    return matrix.money_as_double(titles.title_matrix(sales, AS_OF, whole_amounts=False))


def scale_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = targets.facts_of(
        rel.channel_a(spark, sf_dir, None), rel.channel_s(spark, sf_dir, None)
    )
    accounts = matrix.period_matrix(
        facts, ["CHANNEL", "ACCOUNT"], matrix.ytd(AS_OF, {targets.SIZE: "YTD_TARGET"}), AS_OF
    )
    usable = target_ops.usable_targets(rel.targets(spark, sf_dir), TARGET_YEAR)
    return matrix.money_as_double(
        target_ops.scale_targets(
            accounts, usable, "ACCOUNT", {"YTD_TARGET": "YTD_TARGET"}, f"{TARGET_YEAR}_Target"
        )
    )


def shared_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = target_ops.shared_customers(
        [rel.channel_a(spark, sf_dir, None), rel.channel_s(spark, sf_dir, None)]
    )
    return names.withColumn("MARKED", mark_shared(F.col("NAMECUST")))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return targets.by_customer(
        rel.channel_a(spark, sf_dir),
        rel.channel_s(spark, sf_dir),
        rel.targets(spark, sf_dir),
        AS_OF,
        TARGET_YEAR,
    )


def capture_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _customers(spark, sf_dir).select(
        "NAMECUST",
        "SALES_CATEGORY",
        percent(F.col("YTD_ACTUAL"), F.col("YTD_TARGET")).alias("Capture_Rate"),
        (F.col(f"{TARGET_YEAR}_Target") - F.col("YTD_ACTUAL")).alias("Target_Remaining"),
    )
    return cleaning.whole_numbers(customers, keep=["Capture_Rate"])


def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers, the largest rolling 12 months first."""
    return (
        _customers(spark, sf_dir)
        .select("NAMECUST", "SALES_CATEGORY", "12M_ROLLING_ACTUAL")
        .orderBy(F.col("12M_ROLLING_ACTUAL").desc(), "NAMECUST", "SALES_CATEGORY")
    )


def city_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.when(F.col("c_custkey") % 5 == 0, F.concat("c_name", F.lit("*")))
    customers = rel.table(spark, sf_dir, "customer").select(
        F.coalesce(marked, F.col("c_name")).alias("NAMECUST")
    )
    return targets.add_city_state(customers, rel.locations(spark, sf_dir), "NAMECUST")


def backorders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.combine_backorders(
        rel.raw_backorders_a(spark, sf_dir), rel.backorders_s(spark, sf_dir)
    )


def ingest_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tl.ingest_month(rel.raw_sales(spark, sf_dir), rel.raw_titles(spark, sf_dir))
    return matrix.money_as_double(rows)


def _as_text(spark: SparkSession, df: DataFrame, purpose: str) -> str:
    """Delimited files with a header; white space stays. Returns their folder."""
    path = shared_folder(spark, purpose)
    (
        df.write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def ingest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ingest from delimited text, as the distributor delivers it."""
    names = schemas.RAW_SALES.names
    raw = rel.raw_sales(spark, sf_dir)
    missing = {name: F.lit(None).cast("string") for name in names if name not in raw.columns}
    whole = raw.withColumns(missing).select(*(F.col(f"`{name}`") for name in names))
    read = readers.read_file(spark, _as_text(spark, whole, "raw"), schemas.RAW_SALES)
    return matrix.money_as_double(tl.ingest_month(read, rel.raw_titles(spark, sf_dir)))


def _other_order(df: DataFrame) -> DataFrame:
    """Columns in reverse, and one that nobody asked for."""
    return df.select(F.lit("-").alias("Remark"), *(F.col(f"`{n}`") for n in reversed(df.columns)))


def ingest_file_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another column order, an unknown column, and most unused columns absent."""
    path = _as_text(spark, _other_order(rel.raw_sales(spark, sf_dir)), "raw")
    read = readers.read_by_name(spark, path, schemas.RAW_SALES, optional=ingest.DROPPED)
    return matrix.money_as_double(tl.ingest_month(read, rel.raw_titles(spark, sf_dir)))


def history_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history file read by name, repaired, stored as the whole fact and read back."""
    raw = rel.raw_sales(spark, sf_dir, spoilt_keys=True)
    path, fact = _as_text(spark, _other_order(raw), "history"), shared_folder(spark, "fact")
    read = readers.read_by_name(spark, path, schemas.RAW_SALES, optional=ingest.DROPPED)
    loads.replace_history(tl.reload_history(read, rel.raw_titles(spark, sf_dir)), fact)
    return matrix.money_as_double(loads.read_loads(spark, fact))


def backorder_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distributor's backorders from a file; the report is stored and read back."""
    path = _as_text(spark, _other_order(rel.raw_backorders_a(spark, sf_dir)), "backorders")
    read = readers.read_by_name(spark, path, schemas.RAW_BACKORDERS)
    return _stored(spark, tl.combine_backorders(read, rel.backorders_s(spark, sf_dir)))


def target_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets of the target year from a file without the columns nobody uses."""
    path = _as_text(spark, _other_order(rel.targets(spark, sf_dir).drop("COMPANY")), "targets")
    read = readers.read_by_name(
        spark,
        path,
        schemas.targets_schema(TARGET_YEAR),
        optional=schemas.targets_optional(TARGET_YEAR),
    )
    return matrix.money_as_double(target_ops.usable_targets(read, TARGET_YEAR))


def _stored(spark: SparkSession, report: DataFrame) -> DataFrame:
    """A report as it is read back from where it was stored."""
    path = sinks.replace_table(report, shared_folder(spark, "report"))
    return readers.read_table(spark, path, report.schema)


def _sheets(spark: SparkSession, table: DataFrame, key: str) -> str:
    """A reference map in four files, each with a blank row and notes behind it."""
    first, *others = table.columns
    sheet = F.pmod(F.xxhash64(key), F.lit(4)).cast("int")
    notes = spark.range(12).select(
        F.when(F.col("id") % 3 > 0, "note").alias(first),
        *(F.lit("x").alias(name) for name in others),
        F.floor(F.col("id") / 3).cast("int").alias("_sheet"),
        (1 + F.col("id") % 3).cast("int").alias("_at"),
    )
    rows = table.withColumns({"_sheet": sheet, "_at": F.lit(0)}).unionByName(notes)
    path = shared_folder(spark, "map-file")
    (
        rows.repartition("_sheet")
        .sortWithinPartitions("_sheet", "_at")
        .drop("_at")
        .write.option("header", True)
        .partitionBy("_sheet")
        .csv(path)
    )
    return path


def name_map_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _sheets(spark, rel.name_map(spark, sf_dir), "SOURCE_NAME")
    return readers.read_block(spark, path, schemas.NAME_MAP)


def ingest_past_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest with a title table that also has every key without a title."""
    titles_twice = rel.with_null_rows(rel.raw_titles(spark, sf_dir), ["Z_ID"])
    return matrix.money_as_double(tl.ingest_month(rel.raw_sales(spark, sf_dir), titles_twice))


def dimensions_past_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category, place, name, product and target, each key of which also has a row of nulls."""
    facts = rel.stored_sales_a(spark, sf_dir, None).select(
        "ISBN", "NAMECUST", "SL Account Number", "HQ Account Number", UNITS
    )
    pair = ["SL Account Number", "HQ Account Number"]
    products = rel.with_null_rows(rel.products(spark, sf_dir), ["ISBN"])
    sold = lookups.lookup(facts, products.select("ISBN", "PROD_TYPE"), ["ISBN"])
    account = ["NAMECUST", *pair]
    sums = sinks.written(sold.groupBy(*account, "PROD_TYPE").agg(F.sum(UNITS).alias(UNITS)), "sums")
    # the other tables are met by accounts, once each
    known = distributor.add_category(
        sums.select(*account).distinct(),
        rel.with_null_rows(rel.category_map_a(spark, sf_dir), pair),
    )
    known = targets.add_city_state(
        known, rel.with_null_rows(rel.locations(spark, sf_dir), ["NAMECUST"]), "NAMECUST"
    )
    known = lookups.map_names(
        known.withColumn("_name", F.col("NAMECUST")),
        rel.with_null_rows(rel.name_map(spark, sf_dir), ["SOURCE_NAME"]),
        "_name",
    )
    plan = rel.with_null_rows(rel.targets(spark, sf_dir), ["BILLTO"])
    known = lookups.lookup(
        known, plan.select("BILLTO", "COMPANY"), {"SL Account Number": "BILLTO"}
    )
    rows = channels.with_accounts(sums, known, account)
    return rows.drop("NAMECUST").withColumnRenamed("_name", "NAMECUST").groupBy(
        "SALES_CATEGORY", "NAMECUST", "CITY", "STATE", "PROD_TYPE", "COMPANY"
    ).agg(F.sum(UNITS).alias(UNITS))


def reload_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = rel.raw_sales(spark, sf_dir, spoilt_keys=True)
    return matrix.money_as_double(tl.reload_history(raw, rel.raw_titles(spark, sf_dir)))


def ingest_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest.clean_rows(rel.raw_sales(spark, sf_dir), rel.raw_titles(spark, sf_dir))
    return matrix.money_as_double(tl.ingest_checks(rows))


def ingest_rerun_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history load, then the same monthly load twice; totals per month.

    The sales are put together once for both, and the month's rows once for both loads.
    """
    path = shared_folder(spark, "fact")
    with sinks.held(rel.sales(spark, sf_dir).select(*rel.LINES), "sales") as lines:
        loads.replace_history(rel.stored_a_of(lines).select(*schemas.STORED_SALES.names), path)
        ingested = tl.ingest_month(rel.raw_of(lines), rel.raw_titles(spark, sf_dir))
        with sinks.held(ingested, "month") as month:
            for _ in range(2):
                loads.write_load(month, path, "2001-07")
    totals = loads.read_loads(spark, path).groupBy("YEAR", "MONTH").agg(
        F.sum(UNITS).alias(UNITS), F.sum(DOLLARS).alias(DOLLARS)
    )
    return matrix.money_as_double(totals)


def control_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Before and after the union of the channels and its grouping."""
    before = rel.both_channels(spark, sf_dir)
    both = combined.facts_of(
        rel.channel_a(spark, sf_dir, None), rel.channel_s(spark, sf_dir, None)
    )
    after = both.groupBy("YEAR", "MONTH", *combined.KEYS).agg(
        F.sum(UNITS).alias(UNITS), F.sum(DOLLARS).alias(DOLLARS)
    )
    return matrix.money_as_double(checks.control_totals(before, after, [UNITS, DOLLARS]))


def column_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count and sum of every period column of the matrix."""
    buckets = combined.buckets(AS_OF)
    facts = rel.both_channels(spark, sf_dir)
    report = matrix.period_matrix(facts, combined.KEYS, buckets, AS_OF)
    return matrix.money_as_double(checks.totals(report, [b.name for b in buckets]))


def unmapped_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.unmapped_accounts(
        rel.raw_sales(spark, sf_dir), rel.category_map_a(spark, sf_dir)
    )


def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = rel.both_channels(spark, sf_dir)
    return checks.null_counts(facts, ["ISBN", "TITLE", "NAMECUST", "SALES_CATEGORY"])


def invalid_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.when(F.col("p_size") % 2 == 0, F.format_string("%013d", "p_partkey")).otherwise(
        F.col("p_brand")
    )
    parts = rel.table(spark, sf_dir, "part").select(key.alias("ISBN"))
    return checks.invalid_keys(parts)


def sign_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = checks.sign_profile(rel.both_channels(spark, sf_dir), [UNITS, DOLLARS])
    return matrix.money_as_double(profile)


SAMPLE_KEYS = ["ISBN", "YEAR", "MONTH", "NAMECUST"]


def _grouped_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.both_channels(spark, sf_dir).groupBy(*SAMPLE_KEYS).agg(
        F.sum(UNITS).alias(UNITS), F.sum(DOLLARS).alias(DOLLARS)
    )


def sign_profile_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sign profile of what grouping makes of the rows."""
    profile = checks.sign_profile(_grouped_sales(spark, sf_dir), [UNITS, DOLLARS])
    return matrix.money_as_double(profile)


def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five rows of either sign for units and for dollars, from the grouped rows."""
    grouped = _grouped_sales(spark, sf_dir)
    return matrix.money_as_double(checks.sign_samples(grouped, [UNITS, DOLLARS], SAMPLE_KEYS))


def report_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.report_combined(
        rel.channel_a(spark, sf_dir),
        rel.channel_s(spark, sf_dir),
        None,
        rel.products(spark, sf_dir),
        AS_OF,
    )


def report_combined_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the totals of all accounts as the database keeps them."""
    return tl.report_combined(
        rel.channel_a(spark, sf_dir),
        rel.channel_s(spark, sf_dir),
        rel.rollup(spark, sf_dir),
        rel.products(spark, sf_dir),
        AS_OF,
    )


def stored_distributor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, report_distributor(spark, sf_dir))


def stored_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, report_titles(spark, sf_dir))


def report_distributor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.report_distributor(
        rel.stored_sales_a(spark, sf_dir),
        rel.category_map_a(spark, sf_dir),
        rel.products(spark, sf_dir),
        AS_OF,
    )


def report_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.report_targets(
        rel.channel_a(spark, sf_dir),
        rel.channel_s(spark, sf_dir),
        rel.targets(spark, sf_dir),
        rel.locations(spark, sf_dir),
        AS_OF,
        TARGET_YEAR,
    )


def report_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.report_titles(
        rel.book_level_sales(spark, sf_dir),
        rel.products(spark, sf_dir),
        backorders(spark, sf_dir),
        AS_OF,
    )


def reference_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The category map from files with blank rows and notes, read by block, stored, read."""
    path = _sheets(spark, rel.category_map_a(spark, sf_dir), "SL Account Number")
    out = shared_folder(spark, "map")
    block = readers.read_block(spark, path, schemas.CATEGORY_MAP_A)
    sinks.replace_if_any(block, out)
    return published.read_published(spark, out, schemas.CATEGORY_MAP_A)


def channel_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both channels from stored facts and maps: units per customer and category."""
    sales_a = channels.channel_a(
        rel.stored_sales_a(spark, sf_dir, None),
        rel.category_map_a(spark, sf_dir),
        rel.name_map(spark, sf_dir),
        AS_OF,
    )
    sales_s = channels.channel_s(
        rel.stored_sales_s(spark, sf_dir, None),
        rel.category_map_s(spark, sf_dir),
        AS_OF,
        without="Customer#0000000%",
    )
    return (
        combined.facts_of(sales_a, sales_s)
        .groupBy("NAMECUST", "SALES_CATEGORY")
        .agg(F.sum(UNITS).alias(UNITS))
    )


def _full_refresh(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Maps read by block from files, stored rollup, without the distributor as customer."""
    files = {
        "CATEGORY_MAP_A": (rel.category_map_a, schemas.CATEGORY_MAP_A, "SL Account Number"),
        "CATEGORY_MAP_S": (rel.category_map_s, schemas.CATEGORY_MAP_S, "BILLTO"),
        "NAME_MAP": (rel.name_map, schemas.NAME_MAP, "SOURCE_NAME"),
    }
    maps = {
        name: readers.read_block(spark, _sheets(spark, build(spark, sf_dir), key), schema)
        for name, (build, schema, key) in files.items()
    }
    return daily.daily_refresh(
        spark,
        *rel.stored_facts(spark, sf_dir),
        maps,
        rel.targets(spark, sf_dir),
        rel.products(spark, sf_dir),
        rel.locations(spark, sf_dir),
        shared_folder(spark, "daily"),
        AS_OF,
        TARGET_YEAR,
        rollup=rel.rollup(spark, sf_dir),
        without="Customer#0000000%",
    )


def daily_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_full_refresh(spark, sf_dir)["COMBINED_SALES_REPORT"].path)


def daily_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_full_refresh(spark, sf_dir)["TARGET_REPORT"].path)


def daily_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and rolling 12 months of both reports, read back as stored."""
    written = daily.daily_refresh(
        spark,
        *rel.stored_facts(spark, sf_dir),
        {
            "CATEGORY_MAP_A": rel.category_map_a(spark, sf_dir),
            "CATEGORY_MAP_S": rel.category_map_s(spark, sf_dir),
            "NAME_MAP": rel.name_map(spark, sf_dir),
        },
        rel.targets(spark, sf_dir),
        rel.products(spark, sf_dir),
        rel.locations(spark, sf_dir),
        shared_folder(spark, "daily"),
        AS_OF,
        TARGET_YEAR,
    )
    rolling = {"COMBINED_SALES_REPORT": "12M_UNITS", "TARGET_REPORT": "12M_ROLLING_ACTUAL"}
    return checks.union_all(
        [
            spark.read.parquet(stored.path).agg(
                F.lit(name).alias("REPORT"),
                F.count(F.lit(1)).alias("N_ROWS"),
                F.sum(rolling[name]).alias("TOTAL_12M"),
                F.lit(stored.totals["N_ROWS"]).cast("bigint").alias("SEEN_ROWS"),
                F.lit(stored.totals[rolling[name]]).cast("bigint").alias("SEEN_12M"),
            )
            for name, stored in written.items()
        ]
    )


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Both channels' facts by load: history up to June, then July and what is later."""
    facts = []
    for stored in rel.stored_facts(spark, sf_dir):
        path, july = shared_folder(spark, "fact"), F.expr("YEAR = 2001 AND MONTH >= 7")
        loads.replace_history(stored.filter(~july), path)
        loads.write_load(stored.filter(july), path, "2001-07")
        facts.append(path)
    return tuple(facts)


def _refresh_loads(
    spark: SparkSession, sf_dir: str, facts: tuple[str, str], sums: str, **options
) -> dict[str, sinks.Stored]:
    return daily.refresh_from_loads(
        spark,
        *facts,
        sums,
        {
            "CATEGORY_MAP_A": rel.category_map_a(spark, sf_dir),
            "CATEGORY_MAP_S": rel.category_map_s(spark, sf_dir),
            "NAME_MAP": rel.name_map(spark, sf_dir),
        },
        rel.targets(spark, sf_dir),
        rel.products(spark, sf_dir),
        rel.locations(spark, sf_dir),
        shared_folder(spark, "daily"),
        AS_OF,
        TARGET_YEAR,
        rollup=rel.rollup(spark, sf_dir),
        without="Customer#0000000%",
        **options,
    )


def loads_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined report from sums by load, the second load met by a second refresh."""
    facts, sums = _two_loads(spark, sf_dir), shared_folder(spark, "sums")
    for path, name, shape in zip(facts, "as", (monthly.SHAPE_A, monthly.SHAPE_S), strict=True):
        first = loads.entries(spark, path)[0].load_id
        stored = loads.read_loads(spark, path, shape.fact, load_ids=[first])
        published.publish(monthly.monthly_sums(stored, shape), f"{sums}/{name}/{first}")
    return spark.read.parquet(_refresh_loads(spark, sf_dir, facts, sums)["COMBINED_SALES_REPORT"].path)


def loads_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target report as it was before July came in wrong and history was lost."""
    facts, sums = _two_loads(spark, sf_dir), shared_folder(spark, "sums")
    for path, schema in zip(facts, (schemas.STORED_SALES, schemas.STORED_SALES_S), strict=True):
        wrong = loads.read_loads(spark, path, schema).filter("MONTH % 2 = 1")
        loads.write_load(wrong.withColumn(UNITS, F.col(UNITS) + 1), path, "2001-07")
        loads.replace_history(wrong.limit(10), path)
    found = _refresh_loads(spark, sf_dir, facts, sums, as_of_loads=(2, 2))
    return spark.read.parquet(found["TARGET_REPORT"].path)


def loads_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of a month that comes again: by its name, by another, corrected."""
    path = shared_folder(spark, "fact")
    month = sinks.written(
        rel.stored_sales_a(spark, sf_dir, None).select(*schemas.STORED_SALES.names)
        .filter("YEAR = 2001 AND MONTH = 6"), "sales",
    )
    rows = []
    for step, name, load in (
        ("first", "2001-06", month),
        ("again", "2001-06", month.orderBy(F.desc("ISBN"))),
        ("other name", "june", month.repartition(3)),
        ("corrected", "2001-06", month.filter("MONTH = 6 AND NETUNITS > 0")),
        ("rest", "2001-06-returns", month.filter("NOT NETUNITS > 0")),
    ):
        try:
            loads.write_load(load, path, name)
            taken = "taken"
        except loads.RepeatedLoad:
            taken = "refused"
        seen = loads.read_loads(spark, path).agg(F.count(F.lit(1)).alias("N_ROWS"), F.sum(UNITS).alias(UNITS))
        rows.append(seen.select(F.lit(step).alias("STEP"), F.lit(taken).alias("LOAD"), "N_ROWS", UNITS))
    return checks.union_all(rows)


def published_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report that was replaced by one made from itself, read as of its first version."""
    path = shared_folder(spark, "report")
    first = published.publish(report_titles(spark, sf_dir), path)
    schema = spark.read.parquet(first).schema
    published.publish(published.read_published(spark, path, schema).limit(3), path)
    return published.read_published(spark, path, schema, version=1)


def _spoilt_file(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Raw lines of which some have an unreadable amount, and short lines among them."""
    raw = rel.raw_sales(spark, sf_dir)
    unreadable = F.col("EAN").cast("bigint") % 10 == 3
    amount = F.when(unreadable, "n/a").otherwise(F.col("Net Invc").cast("string"))
    spoilt = _other_order(raw.withColumn("Net Invc", amount))
    white_space = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    lines = spoilt.select(F.to_csv(F.struct("*"), white_space)).union(
        rel.table(spark, sf_dir, "supplier").select(F.concat(F.lit("total,"), "s_name"))
    )
    path = shared_folder(spark, "raw")
    # a header in every file, and lines as they are
    plain = white_space | {"header": "true", "sep": "\x01", "escapeQuotes": "false"}
    lines.toDF(",".join(spoilt.columns)).write.options(**plain).csv(path)
    return readers.read_or_set_aside(spark, path, schemas.RAW_SALES, optional=ingest.DROPPED)


def ingest_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest of a file with bad lines, which are set aside."""
    rows, _ = _spoilt_file(spark, sf_dir)
    return matrix.money_as_double(tl.ingest_month(rows, rel.raw_titles(spark, sf_dir)))


def unreadable_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Its checks, with the number of lines set aside."""
    rows, set_aside = _spoilt_file(spark, sf_dir)
    cleaned = ingest.clean_rows(rows, rel.raw_titles(spark, sf_dir))
    return matrix.money_as_double(tl.ingest_checks(cleaned, set_aside))


def unreadable_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, set_aside = _spoilt_file(spark, sf_dir)
    return set_aside.groupBy("REASON").agg(F.count(F.lit(1)).alias("N_LINES"))


def few_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of the stored fact for the parts of one size, by a condition on its scan."""
    path = shared_folder(spark, "fact")
    stored = rel.stored_sales_a(spark, sf_dir, None).select(*schemas.STORED_SALES.names)
    loads.replace_history(stored, path)
    wanted = rel.products(spark, sf_dir).filter("PUB_STATUS = 17 AND TITLE LIKE '%a%'")
    fact = lookups.restrict_to_few(loads.read_loads(spark, path), wanted, "ISBN")
    return fact.groupBy("ISBN", "YEAR", "MONTH").agg(F.sum(UNITS).alias(UNITS))


def empty_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup that doesn't exist: every sale stays, with a null category."""
    facts = rel.stored_sales_a(spark, sf_dir, None)
    mapped = distributor.add_category(facts, readers.empty(spark, schemas.CATEGORY_MAP_A))
    return mapped.groupBy("NAMECUST", "SALES_CATEGORY").agg(F.sum(UNITS).alias(UNITS))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        lookback_scan,
        standardize,
        union_aggregate,
        distinct_keys,
        ytd,
        months_12,
        trailing_12m,
        trailing_4m,
        prior_years,
        period_matrix,
        period_matrix_null_zero,
        coarse_totals,
        category_lookup,
        name_mapping,
        exclude_customer,
        dedupe_first,
        dedupe_first_hashed,
        skewed_lookup,
        duplicate_keys,
        first_attribute,
        title_fill,
        product_enrich,
        normalize_key_regroup,
        repair_key,
        product_semi_join,
        active_only_inner,
        scale_targets,
        shared_customers,
        capture_rate,
        top_customers,
        city_state,
        backorders,
        ingest_month,
        ingest_file,
        ingest_file_by_name,
        ingest_past_nulls,
        dimensions_past_nulls,
        history_file,
        backorder_file,
        target_file,
        name_map_file,
        reload_history,
        ingest_checks,
        ingest_rerun_safe,
        control_totals,
        column_totals,
        unmapped_audit,
        null_counts,
        invalid_keys,
        sign_profile,
        sign_profile_grouped,
        sample_rows,
        report_combined,
        report_combined_rollup,
        report_distributor,
        report_targets,
        report_titles,
        stored_distributor,
        stored_titles,
        reference_map,
        channel_sources,
        daily_refresh,
        daily_combined,
        daily_targets,
        loads_combined,
        loads_replayed,
        loads_repeated,
        published_version,
        ingest_unreadable,
        unreadable_checks,
        unreadable_lines,
        few_products,
        empty_lookup,
    )
}
