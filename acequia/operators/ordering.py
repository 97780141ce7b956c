"""Ranks and running totals over groups of any size.

A window over one group runs in one task. Where a group may hold a large part
of all rows, its rows are spread over buckets of a hash key first: totals of
the buckets, of which there are at most ``1 << BITS`` a group, give each
bucket's start, and the window runs within a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acequia.session import materialize

BITS = 12


def running(df: DataFrame, groups: list[str], key: str, tie: list[str], value: Column, name: str = "running") -> DataFrame:
    """``df`` with the sum of ``value`` over the rows of the group up to each row, itself included.

    Rows are in order of ``key``, a hexadecimal hash, and ``tie``. With
    ``value`` 1 it is the rank. Rows with a null key come first. The bucket
    totals are joined on the partitioning the window has already.
    """
    value_name, bucket, before = "__value", "__bucket", "__before"
    spread = df.withColumn(value_name, value).withColumn(bucket, F.coalesce(F.substring(key, 1, BITS // 4), F.lit("")))
    keyed = [f"__g{i}" for i in range(len(groups))]
    for g, k in zip(groups, keyed):
        spread = spread.withColumn(k, F.struct(F.col(g).alias("v")))  # a null group is a group
    totals = spread.groupBy(*keyed, bucket).agg(F.sum(value_name).alias("__total"))
    ahead = Window.partitionBy(*keyed).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*keyed, bucket, F.coalesce(F.sum("__total").over(ahead), F.lit(0)).alias(before))
    inside = Window.partitionBy(*keyed, bucket).orderBy(F.col(key).asc_nulls_first(), *tie).rowsBetween(Window.unboundedPreceding, 0)
    out = spread.withColumn("__inside", F.sum(value_name).over(inside)).join(starts, [*keyed, bucket])
    return out.select(*df.columns, (F.col(before) + F.col("__inside")).alias(name))


def position(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """``df`` with each row's place, from 0, in a total order of the whole table.

    Rows are sorted by ranges, written once, and numbered within their range
    from the counts of those before it. Nothing goes through one task.
    """
    ranged = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "ranged")
    counts = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row by range
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__before"))
    return ranged.join(F.broadcast(starts), "__part").select(*df.columns, (F.col("__before") + F.col("__row")).alias(name))
