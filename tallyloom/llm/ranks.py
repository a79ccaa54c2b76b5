"""Running totals over groups of any size, without a task that sees a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.storage import written


def running_totals(
    rows: DataFrame, group: Sequence[str], order: Sequence[str], value: Column, name: str
) -> DataFrame:
    """Adds `name`: the sum of `value` over the rows of the group that come before.

    The rows are range-partitioned by group and order, so that a large group lies
    in many neighbouring partitions. Each partition is summed by itself; the sums
    of the partitions before it, a row for each partition and group, give the
    offset. `order` must tell all rows of a group apart by values that are stored or
    follow from the row, such as `row_key` and a row number from a written table:
    then places don't depend on how rows arrive, a task that runs again deals them
    alike, and even a group of equal rows is spread. The columns of `group` must not
    be null.
    """
    group, order = list(group), list(order)
    dealt = written(
        rows.withColumn("_value", value)
        .repartitionByRange(*group, *order)
        .withColumn("_part", F.spark_partition_id()),
        "ranges",
    )
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    within = (
        Window.partitionBy(*group, "_part")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        dealt.groupBy(*group, "_part")
        .agg(F.sum("_value").alias("_sum"))
        .select(*group, "_part", F.sum("_sum").over(earlier).alias("_before"))
    )
    zero = F.lit(0)
    return (
        dealt.join(offsets, [*group, "_part"])
        .withColumn(
            name,
            F.coalesce("_before", zero) + F.coalesce(F.sum("_value").over(within), zero),
        )
        .drop("_value", "_part", "_before")
    )
