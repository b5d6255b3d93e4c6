"""Mixing sources to target weights by hash thresholds.

Every document has a fixed 60-bit hash. Sizes are summed by source and hash bucket; the bucket that
holds a source's budget is found, and only that bucket is summed again by the next hash bits, until
the threshold is exact. Documents below their source's threshold are taken once more than the rest.
Nothing is sorted, and every summary has at most ``2**LEVEL_BITS`` rows per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regain.llm.common import WORD, Workspace, shielded, table, unshielded

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = "mix-1"
HASH_BITS, LEVEL_BITS = 60, 12


def mix_hash(key: Column, text: Column, seed: str = SEED) -> Column:
    """60 bits that depend on the seed, the key and the text; only rows repeated in both tie."""
    parts = F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(parts.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int], max_repeats: int) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size`` (one row per source).

    Weights repeat along the sources in code-point order, NULL last. A source whose share would exceed
    its cap gets the cap; the others share what is left by weight. Filling in the order of cap over weight
    gives the same targets as sharing out the excess again and again.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place + 1).cast("int"))
    everything = Window.partitionBy()
    filling = Window.orderBy(
        (F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()
    )
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_repeats)
    rows = rows.withColumn("total", F.sum("source_size").over(everything))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double") / F.sum("weight").over(
        filling.rowsBetween(0, Window.unboundedFollowing)
    ).cast("double")
    rows = rows.withColumn("level", level).withColumn("capped", F.col("level") * F.col("weight") >= F.col("cap"))
    rows = rows.withColumn("place", F.row_number().over(filling))
    first_open = F.min(F.when(~F.col("capped"), F.struct("place", "level"))).over(everything)
    rows = rows.withColumn("open_level", first_open["level"])
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("open_level") * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def hash_thresholds(rows: DataFrame, targets: DataFrame, work: Workspace) -> DataFrame:
    """``source, source_size, target, rounds, below``: take every document ``rounds`` times, and once more
    where its hash is under ``below``.

    ``rows`` has ``source, size, h``. The documents under the threshold come as near to the rest of the
    target as whole documents in hash order can.
    """
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    state = targets.withColumn("rounds", rounds).withColumn("rest", F.col("target") - rounds * F.col("source_size"))
    # what is still open in a source: hashes that begin with `prefix`, after `offset` words already taken
    state = work.keep(state.withColumn("prefix", F.lit(0).cast("bigint")).withColumn("offset", F.lit(0).cast("bigint")))
    for used in range(0, HASH_BITS, LEVEL_BITS):
        left = HASH_BITS - used
        left_after, fan = left - LEVEL_BITS, 1 << LEVEL_BITS
        here = state.select(F.col("source").alias("s"), "prefix")
        same = F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", left) == F.col("prefix"))
        bucket = F.shiftright("h", left_after).alias("bucket")
        sums = rows.join(here, same).groupBy("source", bucket).agg(F.sum("size").alias("words"))
        in_order = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        sums = sums.withColumnRenamed("source", "s").withColumn("upto", F.sum("words").over(in_order))
        joined = state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left")
        after, total = F.col("offset") + F.col("upto"), F.col("offset") + F.col("upto") - F.col("words")
        if left_after:
            fits = after <= F.col("rest")
        else:  # a bucket is one hash: it goes in where that brings the sum nearer
            fits = after + total <= 2 * F.col("rest")
        taken = F.coalesce(F.max(F.when(fits, F.col("upto"))), F.lit(0))
        first_over = F.coalesce(F.min(F.when(~fits, F.col("bucket"))), (F.first("prefix") + 1) * fan)
        keys = ["source", "source_size", "target", "rounds", "rest"]
        state = work.keep(
            joined.groupBy(*keys).agg(
                first_over.alias("prefix"), (F.first("offset") + taken).cast("bigint").alias("offset")
            )
        )
    return state.withColumnRenamed("prefix", "below").drop("rest", "offset")


def mix(
    docs: DataFrame, work: Workspace, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED,
    key: str = "doc_id", whole_rows: bool = False,
) -> DataFrame:
    """What the mix takes of each document: ``key, size, source_size, target, taken``.

    With ``whole_rows`` every column of ``docs`` comes along, then ``size, source_size, target, taken``; a
    column of ``docs`` with such a name is replaced. NULL and empty texts have size 0 and are taken 0 words;
    a NULL source is a source of its own, the last; rows equal in key and text are taken or left together;
    an empty table gives an empty table. The sizes decide nothing but the thresholds, so reruns agree.
    """
    given, renamed = shielded(docs, ("_h", "_s", "_rounds", "_below"))
    return unshielded(_mix(given, work, weights, max_repeats, seed, renamed.get(key, key), whole_rows), renamed)


def _mix(
    docs: DataFrame, work: Workspace, weights: Sequence[int], max_repeats: int, seed: str, key: str, whole_rows: bool
) -> DataFrame:
    own = ("size", "source_size", "target", "taken")
    measured = docs.drop(*[c for c in own if c in docs.columns]).withColumns(
        {"size": word_count(F.col("text")), "_h": mix_hash(F.col(key), F.col("text"), seed)}
    )
    narrow = work.keep(measured.select(key, "source", "size", F.col("_h").alias("h")))
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, max_repeats)
    limits = hash_thresholds(narrow, targets, work).withColumnsRenamed({"source": "_s", "rounds": "_rounds", "below": "_below"})
    rows = measured if whole_rows else narrow.withColumnRenamed("h", "_h")
    taken = (F.col("_rounds") + (F.col("_h") < F.col("_below")).cast("bigint")) * F.col("size")
    mixed = rows.join(limits, F.col("source").eqNullSafe(F.col("_s"))).withColumn("taken", taken)
    if whole_rows:
        return mixed.drop("_s", "_h", "_rounds", "_below")
    return mixed.select(key, *own)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), Workspace(spark, "op4"))


# the same mix by sorting: running totals in hash order, and targets by filling sources in order of cap over weight
OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM d GROUP BY source
), f AS (
  SELECT *, CAST((SELECT sum(source_size) FROM s) - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
            / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level,
         row_number() OVER o AS place
  FROM s WINDOW o AS (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, source NULLS LAST)
), t AS (
  SELECT source, source_size,
         CASE WHEN level * weight >= 3 * source_size THEN CAST(3 * source_size AS DOUBLE)
              ELSE weight * (SELECT arg_min(level, place) FROM f AS g WHERE g.level * g.weight < 3 * g.source_size) END AS target
  FROM f
), b AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS rounds FROM t
), r AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.rounds, b.target - b.rounds * b.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS here
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (rounds + CASE WHEN upto + upto - here <= 2 * rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""
