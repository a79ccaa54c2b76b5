"""Sales relations derived from the TPC-H-like tables of a test directory.

One sale is one row of ``lineitem`` with its order, customer and part. The
reports only see these relations, never the tables behind them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.names import all_quoted
from tallyloom.sources.schemas import MONEY, STORED_SALES, STORED_SALES_S
from tallyloom.sources.sinks import written

# The reporting date, for which the test data has twelve full
# months, and the year of the targets.
AS_OF = date(2001, 8, 15)
TARGET_YEAR = 2001


# The schemas of the test tables, so that no file is opened to
# find them out.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey bigint, s_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _long_key(name: str) -> Column:
    """The key with 13 characters, as in the raw files."""
    return F.lpad(_text(name), 13, "0")


def _signed(column: Column) -> Column:
    return F.when(F.col("l_returnflag") == "R", -column).otherwise(column)


def _amount() -> Column:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    kept = F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
    return _signed((price * kept).cast(MONEY))


def _category() -> Column:
    return F.when(F.col("c_custkey") % 17 != 0, F.col("c_mktsegment"))


def sales(spark: SparkSession, sf_dir: str, as_of: date | None = None) -> DataFrame:
    """All sales of both channels, in columns every relation below is taken from.

    With `as_of`, only its look-back window: January three years ago to the
    last complete month, as bounds on the order date that reach the scan.
    """
    orders = table(spark, sf_dir, "orders")
    if as_of is not None:
        orders = orders.filter(
            (F.col("o_orderdate") >= F.lit(date(as_of.year - 3, 1, 1)).cast("timestamp_ntz"))
            & (F.col("o_orderdate") < F.lit(as_of.replace(day=1)).cast("timestamp_ntz"))
        )
    # Orders meet customers first, so that a line moves twice, not three times.
    buyers = orders.join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )


# The columns that the stored fact and the raw file are made of.
LINES = [
    "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "o_orderdate", "o_orderpriority", "c_custkey", "c_nationkey",
    "c_name", "p_name",
]


def _fact_columns() -> list[Column]:
    return [
        _text("l_partkey").alias("ISBN"),
        F.year("o_orderdate").alias("YEAR"),
        F.month("o_orderdate").alias("MONTH"),
        F.col("p_name").alias("TITLE"),
        F.col("c_name").alias("NAMECUST"),
        _signed(F.col("l_quantity").cast("bigint")).alias("NETUNITS"),
        _amount().alias("NETAMT"),
    ]


def _of_a() -> Column:
    return F.col("l_linestatus") == "F"


def channel_a(spark: SparkSession, sf_dir: str, as_of: date | None = AS_OF) -> DataFrame:
    return sales(spark, sf_dir, as_of).filter(_of_a()).select(
        _text("c_nationkey").alias("HQ_NUMBER"),
        _text("c_custkey").alias("SL_NUMBER"),
        *_fact_columns(),
        _category().alias("SALES_CATEGORY"),
    )


def channel_s(spark: SparkSession, sf_dir: str, as_of: date | None = AS_OF) -> DataFrame:
    return sales(spark, sf_dir, as_of).filter(~_of_a()).select(
        _text("c_custkey").alias("ACCOUNT_ID"),
        *_fact_columns(),
        _category().alias("SALES_CATEGORY"),
    )


def both_channels(spark: SparkSession, sf_dir: str, as_of: date | None = None) -> DataFrame:
    """Every sale in the shape both channels share; the channel is left out."""
    return sales(spark, sf_dir, as_of).select(
        *_fact_columns(), _category().alias("SALES_CATEGORY")
    )


def stored_sales_a(spark: SparkSession, sf_dir: str, as_of: date | None = AS_OF) -> DataFrame:
    """Channel A as its stored fact: accounts instead of categories."""
    return stored_a_of(sales(spark, sf_dir, as_of))


def stored_a_of(lines: DataFrame) -> DataFrame:
    return lines.filter(_of_a()).select(
        *_fact_columns(),
        F.when(F.col("l_returnflag") == "N", "N").otherwise("Y").alias("IPS Sale"),
        _text("c_nationkey").alias("HQ Account Number"),
        _text("c_custkey").alias("SL Account Number"),
        F.col("o_orderpriority").alias("SL Class of Trade"),
    )


def stored_sales_s(spark: SparkSession, sf_dir: str, as_of: date | None = AS_OF) -> DataFrame:
    return sales(spark, sf_dir, as_of).filter(~_of_a()).select(
        _text("c_custkey").alias("NEWBILLTO"), *_fact_columns()
    )


def stored_facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both channels' facts of the look-back window as tables of their own, from one pass."""
    stored = written(
        sales(spark, sf_dir, AS_OF).select(
            _of_a().alias("_of_a"),
            *_fact_columns(),
            F.when(F.col("l_returnflag") == "N", "N").otherwise("Y").alias("IPS Sale"),
            _text("c_nationkey").alias("HQ Account Number"),
            _text("c_custkey").alias("SL Account Number"),
            F.col("o_orderpriority").alias("SL Class of Trade"),
        ),
        "facts",
    )
    direct = stored.filter(~F.col("_of_a")).withColumnRenamed("SL Account Number", "NEWBILLTO")
    return (
        stored.filter("_of_a").select(*all_quoted(STORED_SALES.names)),
        direct.select(*all_quoted(STORED_SALES_S.names)),
    )


def book_level_sales(spark: SparkSession, sf_dir: str, as_of: date | None = AS_OF) -> DataFrame:
    return both_channels(spark, sf_dir, as_of).select(
        "ISBN", "TITLE", "YEAR", "MONTH", "NETAMT", F.col("NETUNITS").alias("NETQTY")
    )


def category_map_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account pairs with a category; unmapped accounts are not listed."""
    return (
        table(spark, sf_dir, "customer")
        .filter(_category().isNotNull())
        .select(
            _text("c_custkey").alias("SL Account Number"),
            _text("c_nationkey").alias("HQ Account Number"),
            F.col("c_mktsegment").alias("MASTER SALES CATEGORY"),
        )
    )


def category_map_s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .filter(_category().isNotNull())
        .select(
            _text("c_custkey").alias("BILLTO"),
            F.col("c_mktsegment").alias("MASTER SALES CATEGORY"),
        )
    )


def name_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of nation 0 go by one name, the others are not mapped."""
    return (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_nationkey") == 0)
        .select(
            F.col("c_name").alias("SOURCE_NAME"),
            F.concat(F.lit("Group "), F.col("c_mktsegment")).alias("TARGET_NAME"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _text("p_partkey").alias("ISBN"),
        F.col("p_name").alias("TITLE"),
        F.col("p_type").alias("PROD_TYPE"),
        F.lit(None).cast("string").alias("PUB_DATE"),
        F.col("p_size").alias("PUB_STATUS"),
        F.col("p_brand").alias("PROD_CLASS"),
        F.when(F.col("p_size") > 25, "FALL").otherwise("SPRING").alias("SEAS"),
        F.when(F.col("p_size") != 7, F.col("p_brand")).alias("SUB_PUB"),
        F.col("p_retailprice").alias("RETAIL_PRICE"),
        F.lit(None).cast("string").alias("WEBCAT1"),
        F.col("p_type").alias("WEBCAT2"),
        F.concat(F.lit("About "), F.col("p_type")).alias("WEBCAT2_DESCR"),
        *(F.lit(None).cast("string").alias(name) for name in ("WEBCAT3", "BISAC_CODE")),
        (F.col("p_size") * 10).alias("QTY_ON_HAND"),
        F.col("p_size").cast("double").alias("QTY_ON_ORDER"),
        F.lit(None).cast("string").alias("WATCH"),
        F.col("p_size").alias("CTNQTY"),
        F.lit(0).alias("MINRPTQTY"),
        *(
            F.lit(None).cast("string").alias(name)
            for name in ("GENERAL_COMMENTS", "INTERNAL_COMMENTS", "IWD", "EXPDATE", "SELLOFF")
        ),
    )


def title_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _text("p_partkey").alias("Z_ID"), F.col("p_name").alias("LONG_TITLE")
    )


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    ratio = (
        F.when(key % 11 == 0, F.lit(None).cast("double"))
        .when(key % 13 == 0, F.lit(0.0))
        .otherwise(1 + (key % 5) / 10)
    )
    return table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("BILLTO"),
        F.col("c_name").alias("COMPANY"),
        F.col("c_acctbal").alias(str(TARGET_YEAR)),
        ratio.alias("MUL_RATIO"),
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_name").alias("NAMECUST"),
            F.col("n_name").alias("NAMECITY"),
            F.col("r_name").alias("CODESTTE"),
        )
    )


def _waiting(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "P")
    return (
        table(spark, sf_dir, "lineitem")
        .join(pending, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )


def raw_backorders_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _waiting(spark, sf_dir).filter(_of_a()).select(
        _text("l_partkey").alias("EAN"),
        F.col("p_name").alias("Title"),
        F.col("l_quantity").cast("int").alias("Open Backorder"),
    )


def backorders_s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _waiting(spark, sf_dir).filter(~_of_a()).select(
        _text("l_partkey").alias("ITEMNO"),
        F.col("p_name").alias("TITLE"),
        F.col("l_quantity").cast("int").alias("QTYREC"),
    )


def raw_sales(spark: SparkSession, sf_dir: str, *, spoilt_keys: bool = False) -> DataFrame:
    """All sales as lines of a raw distributor file, with its usual defects.

    Titles of every seventh part are missing, dates of the first line number
    are unreadable, units carry halves, texts carry white space. With
    `spoilt_keys`, product keys look like numbers a spreadsheet has kept.
    """
    return raw_of(sales(spark, sf_dir), spoilt_keys=spoilt_keys)


def raw_of(lines: DataFrame, *, spoilt_keys: bool = False) -> DataFrame:
    ean = _long_key("l_partkey")
    if spoilt_keys:
        ean = F.concat(ean, F.lit(".0"))
    day = F.concat_ws(
        "/", F.month("o_orderdate"), F.dayofmonth("o_orderdate"), F.year("o_orderdate")
    )
    units = _signed(F.col("l_quantity") + F.col("l_linenumber") / 2)
    return lines.select(
        ean.alias("EAN"),
        F.when(F.col("l_partkey") % 7 != 0, F.concat(F.lit("\t"), "p_name", F.lit(" "))).alias(
            "Title"
        ),
        F.concat(F.lit(" "), "c_name").alias("Headquarter"),
        F.when(F.col("l_linenumber") == 1, "garbage").otherwise(day).alias("Date"),
        units.alias("Net Sold Units"),
        _amount().cast("double").alias("Net Invc"),
        F.col("o_orderpriority").alias("SL Class of Trade"),
        F.when(F.col("l_returnflag") == "N", "N").otherwise("Y").alias("IPS Sale"),
        _text("c_nationkey").alias("HQ Account Number"),
        _text("c_custkey").alias("SL Account Number"),
        F.col("l_tax").alias("Gross Invc"),
        F.lit("x").alias("DC"),
    )


def raw_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title lookup by the 13-character key of the raw file, each title twice."""
    once = table(spark, sf_dir, "part").select(
        _long_key("p_partkey").alias("Z_ID"),
        F.col("p_name").alias("LONG_TITLE"),
    )
    again = once.withColumn("LONG_TITLE", F.concat("LONG_TITLE", F.lit(" (2nd)")))
    return once.unionByName(again)


def with_null_rows(table: DataFrame, keys: list[str]) -> DataFrame:
    """Each key once more, with nulls in all other columns."""
    nulls = table.select(
        *(
            F.col(f"`{f.name}`") if f.name in keys else F.lit(None).cast(f.dataType).alias(f.name)
            for f in table.schema.fields
        )
    )
    return table.unionByName(nulls)


def rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rolling 12 months of all accounts per product, as the database keeps it."""
    first, after = date(AS_OF.year - 1, AS_OF.month, 1), AS_OF.replace(day=1)
    day = F.col("o_orderdate")
    return (
        sales(spark, sf_dir)
        .filter((day >= F.lit(first).cast("timestamp_ntz")) & (day < F.lit(after).cast("timestamp_ntz")))
        .select(*_fact_columns())
        .groupBy(F.col("ISBN").alias("ITEMNO"))
        .agg(
            F.sum("NETUNITS").alias("NETQTY"),
            F.sum("NETAMT").cast("double").alias("NETSALES"),
        )
    )
