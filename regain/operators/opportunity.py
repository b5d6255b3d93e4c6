"""Which customers lost profit that can be won back: signals, type, score, rank and reason.

score = largest lost-profit estimate x winnability x recoverability, all in exact decimals.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regain import config as c
from regain.config import Settings
from regain.functions.numbers import round_half_away, safe_div
from regain.functions.text import fmt_money
from regain.operators.ranking import rank_desc
from regain.operators.windows import ReportingDates


def stopped_brands(brands: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Per customer: the brands mostly stopped (largest past profit named first), count and past profit.

    Names are cut to the first few by rank before any text is built, so the state stays small: the others are NULL, which
    the list skips. Names, count and profit come from one pass, so brands are summed up once.
    """
    largest = Window.partitionBy("customer_id").orderBy(F.col("gp_prior_12m").desc(), "brand")
    ranked = brands.filter("is_mostly_stopped").withColumn("n", F.row_number().over(largest))
    name = F.when(F.col("n") <= cfg.top_brands_in_reason, F.coalesce("brand_desc", "brand"))
    return ranked.withColumn("name", name).groupBy("customer_id").agg(
        F.count("*").alias("stopped_brand_count"), F.sum("gp_prior_12m").alias("stopped_brands_gp_prior_12m"),
        F.expr("listagg(name, ', ') within group (order by n)").alias("stopped_brands"),
    )


def year_profits(years: DataFrame, dates: ReportingDates) -> DataFrame:
    """Per customer: profit of the last three complete years, and the same period this and last year."""
    this = F.year(dates.as_of_col)

    def of(year: Column, column: str, name: str) -> Column:
        return F.max(F.when(F.col("sales_year") == year, F.col(column))).alias(name)

    return years.groupBy("customer_id").agg(
        of(this - 3, "full_year_gross_profit", "gp_year_1"),
        of(this - 2, "full_year_gross_profit", "gp_year_2"),
        of(this - 1, "full_year_gross_profit", "gp_year_3"),
        of(this - 1, "same_period_gross_profit", "same_period_gp_last_year"),
        of(this, "same_period_gross_profit", "same_period_gp_this_year"),
    )


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def signals(
    customer_mart: DataFrame, years: DataFrame, stopped: DataFrame, dates: ReportingDates, cfg: Settings = Settings()
) -> DataFrame:
    """Customers who ever bought, with every signal. A missing figure never fires a signal."""
    base = (
        customer_mart.filter(F.col("purchase_status") != "never_purchased")
        .select(
            "customer_id", "customer_name", "salesperson_id", "salesperson_name", "is_house_account", "home_branch_name",
            "purchase_status", "last_purchase_date", "days_since_last_purchase", "avg_days_between_purchases",
            "purchase_invoice_count", "gross_profit_last_12m", "gross_profit_prior_12m",
        )
        .join(year_profits(years, dates), "customer_id", "left")
        .join(stopped, "customer_id", "left")
        .withColumn("stopped_brand_count", F.coalesce("stopped_brand_count", F.lit(0)))
        .withColumn("stopped_brands_gp_prior_12m", F.coalesce("stopped_brands_gp_prior_12m", F.lit(0)))
    )
    y1, y2, y3 = F.col("gp_year_1"), F.col("gp_year_2"), F.col("gp_year_3")
    lower = F.least(y1, y2)
    was, now = F.col("same_period_gp_last_year"), F.col("same_period_gp_this_year")
    gap = F.col("avg_days_between_purchases")
    lapsed = F.col("purchase_status") == "lapsed"
    return (
        base.withColumn("is_two_year_decline", _true((y2 < y1) & (y3 < y2)))
        .withColumn(
            "is_sharp_drop",
            _true((y3 <= F.lit(1 - cfg.sharp_drop_pct) * lower) & (lower - y3 >= F.lit(cfg.min_lost_profit))),
        )
        .withColumn("is_declining", F.col("is_two_year_decline") | F.col("is_sharp_drop"))
        .withColumn(
            "is_behind_this_year",
            _true((was > 0) & (now <= F.lit(1 - cfg.behind_pct) * was) & (was - now >= F.lit(cfg.min_lost_profit))),
        )
        .withColumn("has_rhythm", _true((F.col("purchase_invoice_count") >= cfg.rhythm_min_invoices) & (gap > 0)))
        .withColumn("gap_ratio", safe_div(F.col("days_since_last_purchase"), gap))
        .withColumn("is_gone_quiet", (F.col("has_rhythm") & (F.col("gap_ratio") > cfg.quiet_gap_multiple)) | lapsed)
    )


def with_lost_profit(df: DataFrame) -> DataFrame:
    """The loss each signal implies and the largest of the three: they often describe one drop."""
    y1, y2, y3 = F.col("gp_year_1"), F.col("gp_year_2"), F.col("gp_year_3")
    zero = F.lit(0)
    declining = (
        F.when(F.col("is_two_year_decline"), F.greatest(y1, y2) - y3)
        .when(F.col("is_sharp_drop"), F.least(y1, y2) - y3)
        .otherwise(zero)
    )
    behind = F.when(
        F.col("is_behind_this_year"), F.col("same_period_gp_last_year") - F.col("same_period_gp_this_year")
    ).otherwise(zero)
    shrunk = F.col("gross_profit_prior_12m") - F.col("gross_profit_last_12m")
    quiet = F.when(F.col("is_gone_quiet"), F.greatest(shrunk, zero)).otherwise(zero)
    return (
        df.withColumn("lost_gp_declining", declining)
        .withColumn("lost_gp_this_year", behind)
        .withColumn("lost_gp_gone_quiet", quiet)
        .withColumn(
            "est_lost_gross_profit", F.greatest("lost_gp_declining", "lost_gp_this_year", "lost_gp_gone_quiet")
        )
    )


def with_type(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """former_customer, declining, early_warning, recovering or NULL; first match wins."""
    lapsed = F.col("purchase_status") == "lapsed"
    small = F.lit(cfg.min_lost_profit)
    faded = (F.coalesce("gp_year_2", F.lit(0)) < small) & (F.coalesce("gp_year_3", F.lit(0)) < small)
    slipping = F.col("is_behind_this_year") | F.col("is_gone_quiet")
    declining = F.col("is_declining")
    kind = (
        F.when(lapsed & faded, "former_customer")
        .when(lapsed, "declining")
        .when(slipping & ~declining, "early_warning")
        .when(slipping, "declining")
        .when(declining, "recovering")
    )
    return df.withColumn("opportunity_type", kind)


def with_recoverability(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """How recently they bought, against their own rhythm where there is one."""
    cold = F.lit(cfg.cold_factor)
    factor = F.when(F.col("purchase_status") == "lapsed", cold)
    for limit, value in cfg.gap_steps:
        factor = factor.when(F.col("has_rhythm") & (F.col("gap_ratio") <= limit), F.lit(value))
    factor = factor.when(F.col("has_rhythm"), cold)
    for limit, value in cfg.day_steps:
        factor = factor.when(F.col("days_since_last_purchase") <= limit, F.lit(value))
    return df.withColumn("recoverability_factor", factor.otherwise(cold))


def with_winnability(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    kind = F.col("opportunity_type")
    weight = (
        F.when(kind == "early_warning", F.lit(cfg.weight_early_warning))
        .when(kind == "declining", F.lit(cfg.weight_declining))
        .when(kind == "recovering", F.lit(cfg.weight_recovering))
        .otherwise(F.lit(Decimal("0.0")))
    )
    return df.withColumn("winnability_weight", weight)


def scored(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Signals with type, estimates, factors, unrounded score and the flag. Narrow."""
    df = with_winnability(with_recoverability(with_type(with_lost_profit(df), cfg), cfg), cfg)
    kind, lost = F.col("opportunity_type"), F.col("est_lost_gross_profit")
    return df.withColumn("score", lost * F.col("winnability_weight") * F.col("recoverability_factor")).withColumn(
        "is_flagged",
        kind.isNotNull() & _true(kind != "former_customer") & (lost >= F.lit(cfg.min_lost_profit)),
    )


def reason(dates: ReportingDates) -> Column:
    """Up to four plain-English clauses; a clause whose signal did not fire is skipped."""
    this = F.year(dates.as_of_col)

    def year(back: int) -> Column:
        return (this - back).cast("string")

    def whole(value: Column) -> Column:
        return value.cast("bigint").cast("string")

    def text(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    y1, y2, y3 = F.col("gp_year_1"), F.col("gp_year_2"), F.col("gp_year_3")
    was, now = F.col("same_period_gp_last_year"), F.col("same_period_gp_this_year")
    decline = F.when(
        F.col("is_two_year_decline"),
        text(
            "Gross profit down two years running (", fmt_money(F.greatest(y1, y2)), " in ",
            F.when(y1 >= y2, year(3)).otherwise(year(2)), " to ", fmt_money(y3), " in ", year(1), ")",
        ),
    ).when(
        F.col("is_sharp_drop"),
        text(
            "Gross profit dropped sharply to ", fmt_money(y3), " in ", year(1), " (at least ",
            fmt_money(F.least(y1, y2)), " in each of ", year(3), " and ", year(2), ")",
        ),
    )
    percent = round_half_away(F.lit(100.0) * (F.lit(1.0) - safe_div(now, was)))
    behind = F.when(
        F.col("is_behind_this_year"),
        text(
            year(0), " so far is ", whole(percent), "% behind last year through ",
            F.date_format(dates.as_of_col, "MMM d"), " (", fmt_money(now), " vs ", fmt_money(was), " gross profit)",
        ),
    )
    quiet = F.when(
        F.col("purchase_status") == "lapsed",
        text("No purchase in over 12 months (last on ", F.date_format("last_purchase_date", "yyyy-MM-dd"), ")"),
    ).when(
        F.col("is_gone_quiet"),
        text(
            "No purchase for ", F.col("days_since_last_purchase").cast("string"), " days; normally buys every ",
            whole(round_half_away(F.col("avg_days_between_purchases"))), " days",
        ),
    )
    brands = F.when(F.col("stopped_brand_count") > 0, text("Mostly stopped buying ", F.col("stopped_brands")))
    return F.concat_ws("; ", decline, behind, quiet, brands)


def rep_label(cfg: Settings = Settings()) -> Column:
    return (
        F.when(F.col("salesperson_id") == cfg.house_rep_id, c.HOUSE_LABEL)
        .when(F.col("salesperson_name").isNull() | F.col("is_house_account"), c.NO_REP_LABEL)
        .otherwise(F.col("salesperson_name"))
    )


def opportunities(
    scores: DataFrame, dates: ReportingDates, keep: Callable[[DataFrame], DataFrame], cfg: Settings = Settings()
) -> DataFrame:
    """Scored customers with rank (flagged rows, by unrounded score), rep label and reason."""
    flagged = scores.filter("is_flagged").select("customer_id", "score")
    ranks = rank_desc(flagged, "score", "opportunity_rank", keep).select("customer_id", "opportunity_rank")
    return scores.join(ranks, "customer_id", "left").select(
        "customer_id", F.lit(cfg.company_id).alias("company_id"), "customer_name", rep_label(cfg).alias("salesperson"),
        "home_branch_name", "is_flagged", "opportunity_rank", "opportunity_type",
        F.round("score", 2).alias("priority_score"),
        F.round("est_lost_gross_profit", 2).alias("est_lost_gross_profit"),
        "winnability_weight", "recoverability_factor", reason(dates).alias("reason"),
        "is_declining", "is_two_year_decline", "is_sharp_drop", "is_behind_this_year", "is_gone_quiet",
        F.col("gp_year_1").alias("gp_oldest_complete_year"), F.col("gp_year_2").alias("gp_middle_complete_year"),
        F.col("gp_year_3").alias("gp_latest_complete_year"), "same_period_gp_last_year", "same_period_gp_this_year",
        "gross_profit_prior_12m", "gross_profit_last_12m", "last_purchase_date", "days_since_last_purchase",
        "avg_days_between_purchases", round_half_away(F.col("gap_ratio"), 2).alias("gap_ratio"),
        "lost_gp_declining", "lost_gp_this_year", "lost_gp_gone_quiet", "stopped_brands", "stopped_brand_count",
        "stopped_brands_gp_prior_12m", "purchase_status", dates.as_of_col.alias("as_of_date"),
    )
