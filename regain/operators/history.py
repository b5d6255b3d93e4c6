"""Figures as they stood on many days at once: cumulative sums looked up by date, and purchase days as mergeable state."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regain.functions.numbers import or_zero, safe_div
from regain.operators.analyses import drop_band

VALUES = ("sales", "profit")


def cumulative(days: DataFrame, values: Sequence[str] = VALUES) -> DataFrame:
    """``customer_id, day, days`` and running sums: one row per customer and day with anything. A customer's rows are
    bounded by the calendar, not by the lines."""
    upto = Window.partitionBy("customer_id").orderBy("ship_date").rowsBetween(Window.unboundedPreceding, 0)
    sums = [F.sum(or_zero(F.col(v))).over(upto).alias(v) for v in values]
    return days.filter("ship_date IS NOT NULL").select("customer_id", F.col("ship_date").alias("day"), F.count("*").over(upto).alias("days"), *sums)


def looked_up(running: DataFrame, asked: DataFrame, values: Sequence[str] = VALUES) -> DataFrame:
    """``asked`` (``customer_id, day`` and more) with the running sums on the last day up to its own; 0 before the first.

    An as-of join as one shuffle: questions and sums stand in one line per customer, and each question takes what came last.
    """
    more = [c for c in asked.columns if c not in ("customer_id", "day")]
    names = ["days", *values]
    kinds = dict(running.dtypes)
    questions = asked.withColumns({n: F.lit(None).cast(kinds[n]) for n in names}).withColumn("asks", F.lit(1))
    known = running.withColumns({n: F.lit(None).cast(dict(asked.dtypes)[n]) for n in more}).withColumn("asks", F.lit(0))
    upto = Window.partitionBy("customer_id").orderBy("day", "asks").rowsBetween(Window.unboundedPreceding, 0)
    both = known.unionByName(questions)
    found = both.withColumns({n: F.last(n, ignorenulls=True).over(upto) for n in names}).filter("asks = 1")
    return found.select(*asked.columns, *[or_zero(F.col(n)).alias(n) for n in names])


def month_end_change(days: DataFrame, as_of: dt.date | None) -> DataFrame:
    """Sales and profit of the last 12 months against the 12 before, per customer and month end.

    Every month end up to the month of ``as_of``, for customers with any row in its 24 months. Each costs three look-ups
    in the running sums, whatever the number of lines.
    """
    last = F.last_day(F.lit(as_of).cast("date"))
    spans = days.filter("ship_date IS NOT NULL").groupBy("customer_id").agg(F.min("ship_date").alias("a"), F.max("ship_date").alias("z"))
    until = F.least(F.trunc(last, "month"), F.trunc(F.add_months("z", 24), "month"))
    firsts = F.explode(F.sequence(F.trunc("a", "month"), until, F.expr("interval 1 month"))).alias("month")
    ends = spans.select("customer_id", firsts).select("customer_id", F.last_day("month").alias("month_end"))
    places = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.add_months("month_end", -12 * k).alias("day")) for k in range(3)]))
    asked = ends.select("customer_id", "month_end", places.alias("p")).select("customer_id", "month_end", "p.k", "p.day")
    found = looked_up(cumulative(days), asked)

    def at(k: int, name: str) -> Column:
        return F.max(F.when(F.col("k") == k, F.col(name)))

    out = found.groupBy("customer_id", "month_end").agg(
        (at(0, "days") - at(2, "days")).alias("n"),
        (at(0, "sales") - at(1, "sales")).alias("sales_last_12m"), (at(1, "sales") - at(2, "sales")).alias("sales_prior_12m"),
        (at(0, "profit") - at(1, "profit")).alias("gross_profit_last_12m"),
        (at(1, "profit") - at(2, "profit")).alias("gross_profit_prior_12m"),
    )
    return out.filter("n > 0").drop("n")


def early_drop_by_month(days: DataFrame, as_of: dt.date | None, min_profit: int = 2000) -> DataFrame:
    """For every month end: how a drop by then compares with the result of the whole year, over all complete years.

    The yearly analysis asks this for one day of the year; here the twelve month ends come from one pass of look-ups.
    """
    complete = F.year(F.lit(as_of).cast("date")) - 1
    spans = days.filter("ship_date IS NOT NULL").groupBy("customer_id").agg(
        F.year(F.min("ship_date")).alias("a"), F.bool_or("purchased").alias("buys")
    )
    spans = spans.filter(F.col("buys") & (F.col("a") <= complete))
    years = spans.select("customer_id", F.explode(F.sequence("a", complete)).alias("sales_year"))
    asked = years.select("customer_id", "sales_year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    asked = asked.withColumn("day", F.last_day(F.make_date("sales_year", "month", F.lit(1))))
    found = looked_up(cumulative(days, ("profit",)), asked, ("profit",))
    by_year = found.groupBy("customer_id", "sales_year").agg(
        *[F.max(F.when(F.col("month") == m, F.col("profit"))).alias(f"m{m}") for m in range(1, 13)]
    )
    earlier = Window.partitionBy("customer_id").orderBy("sales_year")
    opening = F.coalesce(F.lag("m12").over(earlier), F.lit(0))
    by_year = by_year.withColumn("opening", opening).select(
        "customer_id", "sales_year", *[(F.col(f"m{m}") - F.col("opening")).alias(f"m{m}") for m in range(1, 13)]
    )
    months = F.array(*[F.col(f"m{m}") for m in range(1, 13)])
    pairs = by_year.select("customer_id", "sales_year", months.alias("now"), F.lag(months).over(earlier).alias("was")).filter("was IS NOT NULL")
    each = pairs.select(
        F.posexplode(F.arrays_zip("now", "was")).alias("at", "p"), F.element_at("now", 12).alias("full_now"), F.element_at("was", 12).alias("full_was")
    ).select((F.col("at") + 1).alias("month_no"), "p.now", "p.was", "full_now", "full_was")
    each = each.filter(F.col("was") >= min_profit).withColumn("band", drop_band(F.col("now"), F.col("was")))
    return each.groupBy("month_no", "band").agg(
        F.count("*").alias("cases"), F.count_if(F.col("full_now") < F.col("full_was")).alias("ended_down"),
        F.count_if(F.col("full_now") * 10 <= F.col("full_was") * 9).alias("ended_down_10"),
    )


# ---- purchase days as state --------------------------------------------------------------------


def rhythm_states(days: DataFrame) -> DataFrame:
    """``customer_id, year, days``: the days of the year with a purchase, ascending. At most 366 numbers a row."""
    bought = days.filter("purchased and ship_date IS NOT NULL")
    return bought.groupBy("customer_id", F.year("ship_date").alias("year")).agg(
        F.array_sort(F.collect_set(F.dayofyear("ship_date"))).alias("days")
    )


def merged_states(parts: Sequence[DataFrame]) -> DataFrame:
    """States of any loads as one: they may come in any order, overlap, or come twice."""
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy("customer_id", "year").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("days")))).alias("days"))


def gap_histogram(states: DataFrame) -> DataFrame:
    """``customer_id, gap, n``: how often each gap between purchase days occurs, those over a new year included."""
    first_day = F.make_date("year", F.lit(1), F.lit(1))
    dated = states.select("customer_id", "year", F.transform("days", lambda d: F.date_add(first_day, d - 1)).alias("dates"))
    before = F.lag(F.element_at("dates", -1)).over(Window.partitionBy("customer_id").orderBy("year"))
    chain = F.when(F.col("before").isNull(), F.col("dates")).otherwise(F.concat(F.array("before"), F.col("dates")))
    chained = dated.withColumn("before", before).select("customer_id", chain.alias("chain"))
    gaps = F.transform(F.sequence(F.lit(2), F.size("chain")), lambda i: F.datediff(F.element_at("chain", i), F.element_at("chain", i - 1)))
    each = chained.filter(F.size("chain") > 1).select("customer_id", F.explode(gaps).alias("gap"))
    return each.groupBy("customer_id", "gap").agg(F.count("*").alias("n"))


def rhythm_of_states(states: DataFrame, multiples: Sequence[int] = (2, 4)) -> DataFrame:
    """Per customer: first and last purchase, purchase days, usual and longest gap, and gaps over multiples of the usual one."""
    first_day = F.make_date("year", F.lit(1), F.lit(1))
    spans = states.groupBy("customer_id").agg(
        F.min(F.date_add(first_day, F.element_at("days", 1) - 1)).alias("first_purchase_date"),
        F.max(F.date_add(first_day, F.element_at("days", -1) - 1)).alias("last_purchase_date"),
        F.sum(F.size("days")).alias("purchase_day_count"),
    )
    span = F.datediff("last_purchase_date", "first_purchase_date")
    spans = spans.withColumn("avg_days_between_purchases", safe_div(span, F.col("purchase_day_count") - 1))
    gaps = gap_histogram(states).join(spans.select("customer_id", F.col("avg_days_between_purchases").alias("usual")), "customer_id")
    counted = gaps.groupBy("customer_id").agg(
        F.max("gap").alias("longest_gap"),
        *[F.coalesce(F.sum(F.when(F.col("gap") > m * F.col("usual"), F.col("n"))), F.lit(0)).alias(f"gaps_over_{m}x") for m in multiples],
    )
    return spans.join(counted, "customer_id", "left").select(
        *spans.columns, "longest_gap", *[or_zero(F.col(f"gaps_over_{m}x")).alias(f"gaps_over_{m}x") for m in multiples]
    )
