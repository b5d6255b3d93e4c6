"""Ordered numbering that never gathers a group in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], value: Column, out: str,
    keep: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Sum of ``value`` over the rows that come earlier in the same group, by a total order.

    A plain window would sort a whole group (or, without a group, the whole table) in one task.
    Here rows are range-partitioned by group and order, each range is written down with its number
    (``keep`` stores the table, so both later reads see the same ranges), totals are summed inside
    each range, and each range adds the totals of the ranges before it. The totals are one row per
    group and range, so they are small whatever the size of a group.
    """
    keys = [F.col(g) for g in group]
    ranged = keep(
        df.withColumn("_v", value).repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id())
    )
    inside = Window.partitionBy("_range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range", *group).agg(F.sum("_v").alias("_total"))
    offsets = totals.withColumn("_offset", F.coalesce(F.sum("_total").over(earlier), F.lit(0))).drop("_total")
    on = ["_range", *group]
    return (
        ranged.withColumn("_inside", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
        .join(offsets, on, "left")
        .withColumn(out, (F.col("_inside") + F.col("_offset")).cast("bigint"))
        .drop("_v", "_range", "_inside", "_offset")
    )


def rank_desc(df: DataFrame, score: str, out: str, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rank()`` of every row by ``score``, highest first; equal scores share a rank.

    Ranks are worked out per distinct score and joined back, so ties cannot pile up.
    """
    counts = df.groupBy(score).agg(F.count("*").alias("_n"))
    ranked = running_total(counts, [], [F.col(score).desc()], F.col("_n"), out, keep)
    ranked = ranked.withColumn(out, F.col(out) + 1).drop("_n")
    return df.join(ranked, score, "left")


def row_numbers(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], out: str, keep: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``row_number()`` per group by a total order."""
    return running_total(df, group, order, F.lit(1), out, keep).withColumn(out, F.col(out) + 1)
