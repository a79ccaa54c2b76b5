"""Left joins against reference data, made safe for size and for skew."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.names import all_quoted, quoted
from tallyloom.sources.sinks import written

# A lookup up to this many bytes is copied to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
# As many keys at most become a condition on a scan.
FEW_KEYS = 100


def first_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: that with the fewest nulls, then the smallest, nulls last.

    A row with a title, category or name is never passed over for one without.
    Values come from one row, they aren't put together from several. A minimum
    over a struct instead of a ranked window, so that a key with very many copies
    is reduced on the map side and never sorted in one task.
    """
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.distinct()
    missing = [F.col(quoted(name)).isNull().cast("int") for name in rest]
    ranked = F.struct(
        reduce(add, missing).alias("_missing"),
        F.array(*missing).alias("_where"),
        F.struct(*all_quoted(rest)).alias("_row"),
    )
    return (
        df.groupBy(*all_quoted(keys))
        .agg(F.min(ranked).alias("_first"))
        .select(*(quoted(n) if n in keys else f"_first._row.{quoted(n)}" for n in df.columns))
    )


def first_by_key_hashed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of :func:`first_by_key`, for a big table with few ties.

    Texts can't be hash-aggregated, so that a minimum over rows sorts the whole table. Here
    a number says how many nulls a row has and where; its minimum per key is
    hash-aggregated and leaves the rows that have it, equal ones once. Only where
    different rows of a key are left are values compared.
    """
    rest = [name for name in df.columns if name not in keys]
    if not rest or len(rest) > 50:
        return first_by_key(df, keys)
    missing = [F.col(quoted(name)).isNull().cast("bigint") for name in rest]
    where = reduce(lambda number, bit: number * 2 + bit, missing)
    ranked = df.withColumn("_rank", reduce(add, missing) * F.lit(1 << len(rest)) + where)
    staged = {key: f"_key_{n}" for n, key in enumerate(keys)}

    def of(table: DataFrame) -> tuple[DataFrame, Column]:
        same = [F.col(quoted(key)).eqNullSafe(F.col(name)) for key, name in staged.items()]
        return table.withColumnsRenamed(staged), reduce(and_, same)

    least, same = of(ranked.groupBy(*all_quoted(keys)).agg(F.min("_rank").alias("_least")))
    left = ranked.join(least, same & (F.col("_rank") == F.col("_least")), "left_semi")
    left = left.select(*all_quoted(df.columns)).distinct()
    counted = left.groupBy(*all_quoted(keys)).agg(F.count(F.lit(1)).alias("_n"))
    tied, same = of(counted.filter("_n > 1").drop("_n"))
    return left.join(tied, same, "left_anti").unionByName(
        first_by_key(left.join(tied, same, "left_semi"), keys)
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of surplus rows."""
    return (
        df.groupBy(*all_quoted(keys))
        .agg((F.count(F.lit(1)) - 1).alias("SURPLUS_ROWS"))
        .filter(F.col("SURPLUS_ROWS") > 0)
    )


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """True if the values of `df` add up to at most `limit` bytes.

    Counts the bytes of each text and 16 for any column of a row. Runs one
    aggregate over the columns of `df`; a single number comes back.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    size = " + ".join(
        [str(16 * len(df.columns)), *(f"coalesce(octet_length({quoted(n)}), 0)" for n in texts)]
    )
    total = df.agg(F.expr(f"sum(cast({size} AS bigint))")).first()[0]
    return (total or 0) <= limit


def splits_hot_keys(spark: SparkSession) -> bool:
    """True if the runtime splits the partitions of hot keys in joins of this session."""
    return all(
        spark.conf.get(f"spark.sql.adaptive.{name}", "true") == "true"
        for name in ("enabled", "skewJoin.enabled")
    )


def hot_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Keys with more rows than an even share of a shuffle partition.

    `_places` is the number of such shares that a key fills. There are fewer of
    these keys than partitions, whatever the size of `df`. `df` is read once; the number
    of rows of each key is stored.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = written(df.groupBy(*all_quoted(keys)).agg(F.count(F.lit(1)).alias("_rows")), "keys")
    rows = counted.agg(F.sum("_rows")).first()[0] or 0
    share = max(1, rows // partitions)
    return counted.filter(F.col("_rows") > share).select(
        *all_quoted(keys), F.ceil(F.col("_rows") / share).alias("_places")
    )


def _with_places(df: DataFrame, hot: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """`_places` of each row: that of its key if it is hot, else 1."""
    same = [F.col(quoted(key)).eqNullSafe(F.col(quoted(of_hot))) for key, of_hot in keys.items()]
    return (
        df.join(F.broadcast(hot), reduce(and_, same), "left")
        .withColumn("_places", F.coalesce("_places", F.lit(1).cast("bigint")))
        .drop(*keys.values())
    )


def _place(keys: Iterable[str]) -> Column:
    """A small number that follows from a key; it takes little room in a shuffle."""
    return F.pmod(F.xxhash64(*all_quoted(keys)), F.lit(256))


def lookup(
    df: DataFrame,
    table: DataFrame,
    keys: Mapping[str, str] | Sequence[str],
    *,
    unique: bool = False,
    measured: bool = True,
    null_safe: bool = False,
    limit: int = BROADCAST_BYTES,
    place: str | None = None,
) -> DataFrame:
    """Left join `table` to `df` without ever adding rows.

    `keys` maps columns of `df` to columns of `table` (or names the shared
    ones). All other columns of `table` come along. Unless it is already
    `unique`, the first row per key is used, see :func:`first_by_key`. A null key finds nothing, or the
    null key with `null_safe`. `place` names a column for a number that follows from the
    key: where rows move, they move by the keys and it, so that whoever groups
    the result by both spares a shuffle, and so does a further lookup by the same keys and
    `place`, which leaves the number as it is.

    Strategy, by the size of `table`:

    * A stored table is measured first. Up to `limit` bytes it is broadcast.
    * A bigger one, or one that is itself a big query (`measured=False`) and is not
      run twice to be measured, is left to the runtime, so that `df` runs and moves once.
      The runtime knows the table's size once it is shuffled, and then
      broadcasts it or, in the sort-merge join, splits the partitions of hot
      keys. It can only split partitions that come straight from a shuffle,
      while a grouped table would be joined where its grouping left it; the
      second join column, a function of the key, makes Spark shuffle it. The
      session is told to split also where that costs a later shuffle.
    * Where the session's runtime doesn't split, the keys of `df` are counted for a
      measured table. A key with more rows than an even share of the shuffle's
      partitions is hot: its rows are dealt to as many places as it fills
      partitions, and only its row of `table` is repeated.
    """
    pairs = dict(keys) if isinstance(keys, Mapping) else {key: key for key in keys}
    small = measured and fits_broadcast(table, limit)
    first = first_by_key_hashed if measured and not small else first_by_key
    right = table if unique else first(table, list(pairs.values()))
    staged = {name: f"_key_{n}" for n, name in enumerate(pairs.values())}
    right = right.withColumnsRenamed(staged)
    found = [name for name in right.columns if name not in staged.values()]

    def matches(left_key: str) -> Column:
        left_side, right_side = F.col(quoted(left_key)), F.col(staged[pairs[left_key]])
        return left_side.eqNullSafe(right_side) if null_safe else left_side == right_side

    clauses = [matches(key) for key in pairs]
    kept = df.columns
    if place is not None and place not in df.columns:
        df, kept = df.withColumn(place, _place(pairs)), [*kept, place]
    left = df
    if small:
        right = F.broadcast(right)
    elif measured and not splits_hot_keys(df.sparkSession):
        hot = hot_keys(df, pairs).withColumnsRenamed({key: f"_hot_{key}" for key in pairs})
        others = all_quoted(name for name in df.columns if name not in pairs)
        # Equal rows are told apart by their task, which a retry doesn't change.
        spread = F.xxhash64(F.spark_partition_id(), *others)
        left = _with_places(df, hot, {key: f"_hot_{key}" for key in pairs}).withColumn(
            "_salt", F.pmod(spread, F.col("_places"))
        )
        right = _with_places(right, hot, {staged[pairs[key]]: f"_hot_{key}" for key in pairs})
        copies = F.sequence(F.lit(0).cast("bigint"), F.col("_places") - 1)
        right = right.withColumn("_copy", F.explode(copies)).drop("_places").hint("merge")
        clauses.append(F.col("_salt") == F.col("_copy"))
    else:
        df.sparkSession.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        of_key = place or "_of_key"
        left = df if place is not None else df.withColumn(of_key, _place(pairs))
        right = right.withColumn("_of_found", _place(staged.values()))
        clauses.append(F.col(of_key) == F.col("_of_found"))
    joined = left.join(right, reduce(and_, clauses), "left")
    return joined.select(*all_quoted([*kept, *found]))


def restrict_to(df: DataFrame, keys_from: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `df` whose key occurs in `keys_from` (a semi join on distinct keys)."""
    wanted = keys_from.select(*all_quoted(keys)).distinct()
    return df.join(wanted, list(keys), "left_semi")


def restrict_to_few(
    df: DataFrame, keys_from: DataFrame, key: str, most: int = FEW_KEYS
) -> DataFrame:
    """Like `restrict_to` by one column, for a few keys against a huge stored relation.

    Up to `most` keys become a condition on the scan of `df`, which passes over row groups
    that have none of them: by their bounds if the relation is in the order of the column,
    and by their Bloom filters. More keys are joined. `keys_from` should be cheap, since it
    runs here.
    """
    wanted = keys_from.select(F.col(quoted(key))).filter(F.col(quoted(key)).isNotNull()).distinct()
    found = [row[0] for row in wanted.limit(most + 1).collect()]
    if len(found) > most:
        return restrict_to(df, keys_from, [key])
    # in tens, of which each is looked for by itself; a longer list only gives bounds
    tens = [F.col(quoted(key)).isin(found[at : at + 10]) for at in range(0, len(found), 10)]
    return df.filter(reduce(or_, tens, F.lit(False)))


def missing_from(df: DataFrame, table: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Rows per key of `df` that `table` does not know, including null keys.

    The keys are counted first, so the anti join sees each of them once.
    """
    counted = df.groupBy(*all_quoted(keys)).agg(
        F.count(F.lit(1)).alias("ROWS_WITHOUT")
    )
    known = table.select(
        *(F.col(quoted(name)).alias(f"_key_{n}") for n, name in enumerate(keys.values()))
    ).distinct()
    matches = [F.col(quoted(key)) == F.col(f"_key_{n}") for n, key in enumerate(keys)]
    return counted.join(known, reduce(and_, matches), "left_anti")


def map_names(df: DataFrame, names: DataFrame, column: str = "NAMECUST") -> DataFrame:
    """Replace names the map knows by their canonical form, keep the others."""
    canonical = names.select(
        F.col("SOURCE_NAME"), F.col("TARGET_NAME").alias("_canonical_name")
    )
    return (
        lookup(df, canonical, {column: "SOURCE_NAME"})
        .withColumn(column, F.coalesce("_canonical_name", column))
        .drop("_canonical_name")
    )


def fill_from(
    df: DataFrame,
    table: DataFrame,
    keys: Mapping[str, str],
    column: str,
    source: str,
    *,
    place: str | None = None,
) -> DataFrame:
    """Fill nulls of `column` with `source` of the row `table` has for the key.

    `place` is as in :func:`lookup`.
    """
    filler = table.select(
        *(F.col(quoted(name)) for name in keys.values()), F.col(quoted(source)).alias("_filler")
    )
    return (
        lookup(df, filler, keys, place=place)
        .withColumn(column, F.coalesce(F.col(quoted(column)), F.col("_filler")))
        .drop("_filler")
    )
