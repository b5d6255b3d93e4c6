"""Distinct counts that merge: bitmaps per owner and month, of members numbered densely.

A month's bitmap says which members an owner met in it. Bitmaps of any months merge by OR, and the bits of the result are
the exact distinct count, so a window over months reads no line, and a month that is loaded twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regain.operators.ranking import row_numbers

BITS = 64  # of a bucket


def dense_numbers(rows: DataFrame, member: str, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``member, member_no``: every member once, numbered from 1 in order, without a sort in one task."""
    known = rows.select(member).filter(F.col(member).isNotNull()).distinct()
    return row_numbers(known, [], [F.col(member)], "member_no", keep)


def monthly_bitmaps(rows: DataFrame, owner: str, member: str, numbers: DataFrame, date: str = "ship_date") -> DataFrame:
    """``owner, month, bucket, members``: which members each owner met in each month, 64 to a bucket, in eight bytes.

    Members of an owner are few among all, so a bucket mostly has one: a wide one would be empty but for that. Pairs are
    made distinct before they meet the numbers, so the lines are read once and combined before the shuffle.
    """
    month = F.trunc(date, "month").alias("month")
    met = rows.filter(F.col(owner).isNotNull() & F.col(member).isNotNull() & F.col(date).isNotNull())
    numbered = met.select(owner, month, member).distinct().join(numbers, member)
    bit = F.expr(f"shiftleft(1L, cast((member_no - 1) % {BITS} as int))")
    words = numbered.groupBy(owner, "month", F.expr(f"(member_no - 1) div {BITS}").alias("bucket")).agg(F.bit_or(bit).alias("word"))
    return words.select(owner, "month", "bucket", _bytes("word").alias("members"))


def _bytes(word: str) -> Column:
    return F.unhex(F.lpad(F.hex(word), BITS // 4, "0"))


def _word(members: str) -> Column:
    return F.conv(F.hex(members), 16, -10).cast("bigint")


def merged(parts: Sequence[DataFrame], owner: str) -> DataFrame:
    """Bitmaps of several loads as one table, whatever they share."""
    every = reduce(DataFrame.unionByName, parts)
    words = every.groupBy(owner, "month", "bucket").agg(F.bit_or(_word("members")).alias("word"))
    return words.select(owner, "month", "bucket", _bytes("word").alias("members"))


def rolling_distinct(monthly: DataFrame, owner: str, out: str, months: int = 12) -> DataFrame:
    """``owner, month, out``: distinct members over the months up to and with each month the owner has any.

    A bucket's count changes only in a month it has members in, and ``months`` later, when they leave. These changes add up
    to the owner's count, so a bucket is not spread over the months it has nothing new in.
    """
    at = F.year("month") * 12 + F.month("month")
    chains = monthly.select(owner, "bucket", "month", at.alias("at"), _word("members").alias("word")).repartition(owner, "bucket")
    changes = F.explode(F.array(
        F.struct("at", "month", "word"),
        F.struct((F.col("at") + months).alias("at"), F.lit(None).cast("date").alias("month"), F.lit(0).cast("bigint").alias("word")),
    ))
    each = chains.select(owner, "bucket", changes.alias("c")).select(owner, "bucket", "c.*")
    chain = Window.partitionBy(owner, "bucket").orderBy("at")
    counted = each.withColumn("n", F.bit_count(F.bit_or("word").over(chain.rangeBetween(1 - months, 0))))
    steps = counted.withColumn("step", F.col("n") - F.lag("n", 1, 0).over(chain)).filter("step <> 0 or month is not null")
    by_month = steps.groupBy(owner, "at").agg(F.max("month").alias("month"), F.sum("step").alias("step"))
    upto = Window.partitionBy(owner).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return by_month.withColumn(out, F.sum("step").over(upto)).filter("month is not null").select(owner, "month", out)
