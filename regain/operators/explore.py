"""Queries behind the sales page, for all customers at once or for one (``customer_id``)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regain import config as c
from regain.functions.numbers import or_zero
from regain.operators.windows import ReportingDates


def _of(df: DataFrame, customer_id: str | None) -> DataFrame:
    return df if customer_id is None else df.filter(F.col("customer_id") == F.lit(customer_id))


def _since(detail: DataFrame, since: dt.date | None) -> DataFrame:
    """Rows from that day on; where the table is laid out by year, earlier years are not read."""
    if since is None:
        return detail
    if "ship_year" in detail.columns:
        detail = detail.filter(F.col("ship_year") >= since.year)
    return detail.filter(F.col("ship_date") >= F.lit(since))


def ranked_list(
    opportunities: DataFrame, salespeople: Sequence[str] = (), branches: Sequence[str] = (), types: Sequence[str] = (),
    min_score=0,
) -> DataFrame:
    """Flagged customers by rank with display labels; each filter applies only when given."""
    labels = F.create_map(*[F.lit(x) for pair in c.TYPE_LABELS.items() for x in pair])
    view = opportunities.filter("is_flagged").withColumn("opportunity_type", labels[F.col("opportunity_type")])
    for column, chosen in (("salesperson", salespeople), ("home_branch_name", branches), ("opportunity_type", types)):
        if chosen:
            view = view.filter(F.col(column).isin(*chosen))
    return (
        view.filter(F.col("priority_score") >= min_score)
        .select(
            "opportunity_rank", "customer_id", "customer_name", "salesperson", "home_branch_name", "opportunity_type",
            "priority_score", "est_lost_gross_profit", "reason", "last_purchase_date", "days_since_last_purchase",
            "as_of_date",
        )
        .orderBy("opportunity_rank", "customer_id")
    )


def headline_totals(ranked: DataFrame) -> DataFrame:
    return ranked.agg(
        F.count("*").alias("customers"),
        or_zero(F.sum("est_lost_gross_profit")).alias("est_lost_gross_profit"),
        or_zero(F.sum("priority_score")).alias("expected_recoverable"),
    )


def first_of_list(opportunities: DataFrame) -> dict:
    """The customer ranked first, with the values the list's filters would be set to for it; empty without flagged customers."""
    first = opportunities.filter("is_flagged").orderBy("opportunity_rank", "customer_id").select(
        "customer_id", "salesperson", "home_branch_name", "opportunity_type", "priority_score"
    ).first()
    return {} if first is None else first.asDict()


def filter_values(opportunities: DataFrame) -> DataFrame:
    """Choices of the salesperson and branch filters."""
    flagged = opportunities.filter("is_flagged")
    reps = flagged.select(F.lit("salesperson").alias("filter"), F.col("salesperson").alias("value"))
    homes = flagged.select(F.lit("home_branch").alias("filter"), F.col("home_branch_name").alias("value"))
    return reps.unionByName(homes).filter("value is not null").distinct().orderBy("filter", "value")


def customer_contact(customer_mart: DataFrame, customer_id: str | None = None) -> DataFrame:
    """Contact block; linked accounts only where there are several."""
    several = F.col("account_ids").contains(",")
    return _of(customer_mart, customer_id).select(
        "customer_id", "customer_name",
        F.nullif(F.concat_ws(", ", "city", "state"), F.lit("")).alias("location"),
        "phone", "email", F.when(several, F.col("account_ids")).alias("linked_accounts"),
    )


def customer_kpis(opportunities: DataFrame, customer_id: str | None = None) -> DataFrame:
    now, before = F.col("gross_profit_last_12m"), F.col("gross_profit_prior_12m")
    this, last = F.col("same_period_gp_this_year"), F.col("same_period_gp_last_year")
    return _of(opportunities, customer_id).select(
        "customer_id", "last_purchase_date", "days_since_last_purchase", "avg_days_between_purchases",
        "gross_profit_last_12m", (now - before).alias("gross_profit_change_12m"),
        "same_period_gp_this_year", (this - last).alias("same_period_change"),
    )


def monthly_profit(
    detail: DataFrame, dates: ReportingDates, customer_id: str | None = None, since: dt.date | None = None
) -> DataFrame:
    """Customer x month profit, and whether the month is the unfinished last one."""
    money = _since(_of(detail, customer_id), since).filter("is_financial and customer_id is not null")
    month = F.trunc("ship_date", "month")
    partial = (month == F.trunc(dates.as_of_col, "month")) & (dates.as_of_col != F.last_day(dates.as_of_col))
    return (
        money.groupBy("customer_id", month.alias("month"))
        .agg(F.sum("gross_profit").alias("gross_profit"), F.bool_or(partial).alias("is_partial_month"))
        .orderBy("customer_id", "month")
    )


def yearly_profit(years: DataFrame, customer_id: str | None = None) -> DataFrame:
    return (
        _of(years, customer_id)
        .select("customer_id", "sales_year", "full_year_gross_profit", "same_period_gross_profit", "is_partial_year")
        .orderBy("customer_id", "sales_year")
    )


def top_brand_drops(brands: DataFrame, customer_id: str | None = None, top: int = 15) -> DataFrame:
    """Each customer's biggest brand drops, brand code deciding equal drops."""
    change = F.col("gp_last_12m") - F.col("gp_prior_12m")
    order = Window.partitionBy("customer_id").orderBy(change, "brand")
    return (
        _of(brands, customer_id).withColumn("position", F.row_number().over(order)).filter(F.col("position") <= top)
        .select(
            "customer_id", "position", F.col("brand").alias("brand_code"), F.coalesce("brand_desc", "brand").alias("brand"),
            "gp_prior_12m", "gp_last_12m", "is_mostly_stopped",
        )
    )


def recent_invoices(
    detail: DataFrame, customer_id: str | None = None, top: int = 15, since: dt.date | None = None
) -> DataFrame:
    """Each customer's latest invoices, one row per date, invoice and branch; totals match the header."""
    keys = ["customer_id", "ship_date", "invoice_no", "ship_branch_name"]
    totals = _since(_of(detail, customer_id), since).filter("is_financial and customer_id is not null").groupBy(*keys).agg(
        F.count_if(F.col("row_source") == "product_line").alias("lines"),
        F.sum("revenue").alias("sales"),
        F.sum("gross_profit").alias("gross_profit"),
    )
    order = Window.partitionBy("customer_id").orderBy(
        F.col("ship_date").desc(), "invoice_no", F.col("ship_branch_name").asc_nulls_last()
    )
    return totals.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= top)


def sheet_by_brand(
    sheet: DataFrame, customer_id: str | None = None, brand: str | None = None, first: int = 10
) -> DataFrame:
    """The call sheet of one brand, or the first rows over all brands."""
    view = _of(sheet, customer_id)
    view = view.filter(F.col("product_rank") <= first) if brand is None else view.filter(F.col("brand") == F.lit(brand))
    return view.select(
        "customer_id", "product_rank", "status", "product_desc", "brand_desc", "gp_prior_12m", "gp_last_12m",
        "avg_units_per_month_before", "last_purchase_date", "last_unit_price", "current_typical_price",
        "available_home_branch", "available_all_branches", "best_branch", "best_branch_available",
    ).orderBy("customer_id", "product_rank")


def product_type_reference(products: DataFrame, top: int = 5) -> DataFrame:
    """Per product type: brands sold, revenue, and the top brands by revenue."""
    by_brand = (
        products.filter("not is_non_product and product_type is not null")
        .groupBy("product_type", "product_type_desc", F.coalesce("brand_desc", "brand").alias("brand"))
        .agg(F.sum("revenue_last_12m").alias("revenue"))
    )
    keys = ["product_type", "product_type_desc"]
    largest = Window.partitionBy(*keys).orderBy(F.col("revenue").desc(), "brand")
    names = by_brand.filter("brand is not null").withColumn("n", F.row_number().over(largest)).filter(F.col("n") <= top)
    top_names = names.groupBy("product_type").agg(F.expr("listagg(brand, ', ') within group (order by n)").alias("top_brands"))
    totals = by_brand.groupBy(*keys).agg(
        F.count_if(F.col("revenue") > 0).alias("brands_sold_last_12m"), F.sum("revenue").alias("revenue_last_12m")
    )
    return totals.join(top_names, "product_type", "left").orderBy(F.col("revenue_last_12m").desc(), "product_type")
