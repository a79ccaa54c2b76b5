"""Scans. Every read has an explicit schema; nothing is inferred."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.names import all_quoted, quoted
from tallyloom.functions.text import strip
from tallyloom.sources.sinks import written

# Column that holds a line with the wrong number of fields while it is read.
BROKEN = "_broken_line"


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, **options: str
) -> DataFrame:
    """A stored Parquet relation, pruned to the declared columns."""
    df = spark.read.schema(schema).options(**options).parquet(path)
    return df.select(*all_quoted(schema.names))


def read_file(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """A raw delimited file with a header line; keys are text by schema.

    Columns are matched by position, so the header must name them in the order
    of the schema; a header that does not fails the read.
    """
    settings = {"header": "true", "enforceSchema": "false", "mode": "FAILFAST", **options}
    return spark.read.schema(schema).options(**settings).csv(path)


def read_by_name(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    optional: Collection[str] = (),
    **options: str,
) -> DataFrame:
    """A delimited file whose header may name the columns in any order.

    Columns that `schema` doesn't have are left out. A column of `optional` that
    the file lacks is null; any other missing column fails the read. Values are
    read as text, so that product keys keep their zeros, and cast to the schema.
    """
    raw = _with_header(spark, path, options)
    return raw.select(*_named(raw, path, schema, optional))


def _with_header(spark: SparkSession, path: str, options: Mapping[str, str]) -> DataFrame:
    return spark.read.options(**{"header": "true", "mode": "FAILFAST", **options}).csv(path)


def _named(
    raw: DataFrame,
    path: str,
    schema: T.StructType,
    optional: Collection[str] = (),
    *,
    clean: bool = False,
) -> list[Column]:
    """The columns of `schema`; with `clean`, a value that doesn't fit is null."""
    absent = [name for name in schema.names if name not in raw.columns]
    if needed := sorted(set(absent) - set(optional)):
        raise ValueError(f"{path} has no column {', '.join(needed)}")
    given = {f.name: F.lit(None) if f.name in absent else F.col(quoted(f.name)) for f in schema.fields}
    return [
        (given[f.name].try_cast(f.dataType) if clean else given[f.name].cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]


def read_or_set_aside(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    optional: Collection[str] = (),
    **options: str,
) -> tuple[DataFrame, DataFrame]:
    """`read_by_name` for a file with unreadable lines: the rows, and the lines set aside.

    A line is set aside if it has more or fewer fields than the header or a value that its
    column's type can't take: FILE, LINE as it stands (put together from its fields again
    if only a value is wrong) and REASON, which names the first such column. The file is
    scanned once; what is read is stored, and both results come from there.
    """
    names = _with_header(spark, path, options).columns
    whole = T.StructType([*(T.StructField(n, T.StringType()) for n in names), T.StructField(BROKEN, T.StringType())])
    settings = {"header": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN, **options}
    raw = spark.read.schema(whole).options(**settings).csv(path)
    columns = _named(raw, path, schema, optional, clean=True)
    reasons = [F.when(F.col(BROKEN).isNotNull(), F.lit("number of fields"))]
    for field in schema.fields:
        if field.name in names and not isinstance(field.dataType, T.StringType):
            given = F.col(quoted(field.name))
            reasons.append(
                F.when(given.isNotNull() & given.try_cast(field.dataType).isNull(), F.lit(field.name))
            )
    # all fields are asked for, since a line is only checked as far as it is read; only lines set
    # aside are put together again
    size = " + ".join(f"coalesce(octet_length({quoted(name)}), 0)" for name in [*names, BROKEN])
    line = F.coalesce(F.col(BROKEN), F.to_csv(F.struct(*all_quoted(names))))
    reason = F.coalesce(*reasons)
    read = written(
        raw.select(
            F.struct(*columns).alias("row"),
            reason.alias("REASON"),
            F.when(reason.isNotNull(), line).alias("LINE"),
            F.expr(size).alias("_size"),
            F.when(reason.isNotNull(), F.col("_metadata.file_path")).alias("FILE"),
        ),
        "read",
    )
    return (
        read.filter("REASON IS NULL").select("row.*"),
        read.filter("REASON IS NOT NULL").select("FILE", "LINE", "REASON"),
    )


def read_block(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """A reference map: the rows above the first blank in the first column.

    Each file is a sheet of its own and is cut by itself, at its own first blank. A
    row's place is the offset of its split plus a running number inside it, so the
    cut holds however a file is split. Columns go by the names in the header.
    """
    if any(not isinstance(field.dataType, T.StringType) for field in schema.fields):
        raise ValueError("a reference map has string columns only")
    raw = _with_header(spark, path, options)
    placed = raw.select(
        *_named(raw, path, schema),
        F.col("_metadata.file_path").alias("_file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("_place"),
    )
    first = F.col(quoted(schema.names[0]))
    blank = F.coalesce(strip(first), F.lit("")) == ""
    ends = placed.filter(blank).groupBy("_file").agg(F.min("_place").alias("_end"))
    above = F.col("_end").isNull() | (F.col("_place") < F.col("_end"))
    return placed.join(ends, "_file", "left").filter(above).select(*all_quoted(schema.names))


def jdbc_predicates(first_year: int, last_year: int) -> list[str]:
    """A condition for each month: as many connections, none with a year to itself."""
    return [
        f"YEAR = {year} AND MONTH = {month}"
        for year in range(first_year, last_year + 1)
        for month in range(1, 13)
    ]


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    first_year: int,
    last_year: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table with YEAR and MONTH; filters and columns are pushed down."""
    months = jdbc_predicates(first_year, last_year)
    return spark.read.jdbc(url, table, predicates=months, properties=dict(properties or {}))


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed stand-in for a lookup that does not exist. Never used by default."""
    return spark.createDataFrame([], schema)
