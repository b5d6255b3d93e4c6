"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regain.llm.common import Workspace


def components(links: DataFrame, work: Workspace) -> DataFrame:
    """``id, component`` for every id of ``links`` (columns ``a, b``): the smallest id it can reach.

    Each round an id takes the smallest label among its neighbours and then that label's own label, so
    labels travel twice as far every time. Each round is written down; the loop ends when nothing changes.
    """
    both = links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct()
    both = work.keep(both)
    labels = work.keep(both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("component")))
    while True:
        seen = labels.withColumnRenamed("id", "a")
        heard = both.join(seen, "a").groupBy(F.col("b").alias("id")).agg(F.min("component").alias("heard"))
        lower = labels.join(heard, "id").select("id", "component", F.least("component", "heard").alias("lower"))
        onward = labels.select(F.col("id").alias("lower"), F.col("component").alias("onward"))
        step = work.keep(
            lower.join(onward, "lower", "left").select(
                "id", F.least("lower", F.coalesce("onward", "lower")).alias("component"), F.col("component").alias("was")
            )
        )
        moved = step.filter("component <> was").limit(1).count()
        work.drop(labels)
        labels = step
        if not moved:
            work.drop(both)
            return labels.select("id", "component")
