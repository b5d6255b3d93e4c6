"""Groups that links lead to, by turning links into stars until nothing changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Keep = Callable[[DataFrame], DataFrame]


def _to_smallest(links: DataFrame, larger_only: bool) -> DataFrame:
    """Every account's links bent to the smallest account near it: those of its larger neighbours, or of the smaller ones
    and itself. A link never leads out of its group, and there are never more of them than before."""
    if larger_only:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        bent = both.filter("b > a").join(near, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        near = down.groupBy("a").agg(F.min("b").alias("least"))
        bent = down.join(near, "a").select("b", "least").union(near.select("a", "least")).toDF("a", "b")
    return bent.filter("a <> b").distinct()


def linked_groups(links: DataFrame, keep: Keep) -> DataFrame:
    """``account, group`` for all accounts of ``links`` (``a, b``); the group is the smallest account links lead to.

    Links are bent to larger and smaller neighbours in turn until they are stars around the smallest account, which a
    chain of k links reaches in about log k rounds. Every round is written, so a lost executor repeats one round at most.
    """
    accounts = links.select(F.col("a").alias("account")).union(links.select("b")).distinct()
    now = keep(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        bent = keep(_to_smallest(_to_smallest(now, True), False))
        seen = bent.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if seen == mark:
            break
        mark, now = seen, bent
    stars = now.select(F.col("a").alias("account"), F.col("b").alias("group"))
    return accounts.join(stars, "account", "left").select("account", F.coalesce("group", "account").alias("group"))
