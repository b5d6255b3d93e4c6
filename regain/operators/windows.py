"""Reporting windows and the pre-aggregations every customer figure is built from.

Windows are (start, end]. The three dates are read once as literals (``ReportingDates``), so date
filters reach the Parquet scan and prune files and row groups; a join to a one-row table would not.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regain.config import Settings
from regain.functions.numbers import has_dropped, or_zero, sum_when

# places of the parts in a packed (date, price, quantity): price needs 18 digits, quantity 10
DATE_UNIT = Decimal(10**28)
PRICE_UNIT = Decimal(10**10)


def reporting_dates(lines: DataFrame) -> DataFrame:
    """One row: the latest ship date and the starts of the last and prior 12 months."""
    latest = lines.agg(F.max("ship_date").alias("as_of_date"))
    return latest.select(
        "as_of_date",
        F.add_months("as_of_date", -12).alias("last_12m_start"),
        F.add_months("as_of_date", -24).alias("prior_12m_start"),
    )


@dataclass(frozen=True)
class ReportingDates:
    as_of: dt.date | None
    last_start: dt.date | None
    prior_start: dt.date | None

    @classmethod
    def read(cls, dates: DataFrame) -> "ReportingDates":
        """One row to the driver: three dates."""
        return cls(*dates.select("as_of_date", "last_12m_start", "prior_12m_start").first())

    @staticmethod
    def _date(value: dt.date | None) -> Column:
        return F.lit(value).cast("date")

    @property
    def as_of_col(self) -> Column:
        return self._date(self.as_of)

    def in_last(self, date: str = "ship_date") -> Column:
        return F.col(date) > self._date(self.last_start)

    def in_prior(self, date: str = "ship_date") -> Column:
        return (F.col(date) > self._date(self.prior_start)) & (F.col(date) <= self._date(self.last_start))

    def in_either(self, date: str = "ship_date") -> Column:
        return F.col(date) > self._date(self.prior_start)

    def in_same_period(self, date: str = "ship_date") -> Column:
        """On or before the as-of month and day, in any year. Text comparison, so Feb 29 is safe."""
        return F.date_format(date, "MM-dd") <= F.date_format(self.as_of_col, "MM-dd")


def customer_days(tx: DataFrame) -> DataFrame:
    """Customer x ship date: money and purchase flags.

    The one pass over the transactions that recency, windows, lifetime, rhythm and yearly figures
    share. Partial sums run map-side and the shuffle key includes the day, so a customer with a
    third of all rows is spread over as many keys as there are days.
    """
    financial = F.col("is_financial")
    return tx.groupBy("customer_id", "ship_date").agg(
        sum_when(financial, F.col("ext_price")).alias("sales"),
        sum_when(financial, F.col("gross_profit")).alias("profit"),
        sum_when(F.col("is_return_credit"), F.col("ext_price")).alias("returns"),
        F.coalesce(F.bool_or("is_purchase"), F.lit(False)).alias("purchased"),
        F.bool_or(F.col("is_consignment") & financial).alias("consigned"),
    )


def purchase_invoices(lines: DataFrame) -> DataFrame:
    """Customer x purchase invoice x year with the latest ship date: distinct counts become plain counts."""
    return (
        lines.filter(F.col("is_purchase") & F.col("invoice_no").isNotNull())
        .groupBy("customer_id", "invoice_no", F.year("ship_date").alias("sales_year"))
        .agg(F.max("ship_date").alias("last_ship_date"))
    )


def product_changes(lines: DataFrame, products: DataFrame, dates: ReportingDates, cfg: Settings = Settings()) -> DataFrame:
    """Customer x product over 24 months: profit and units before and now, last price paid.

    The last unit price belongs to the latest purchase; on a shared date the highest extended price,
    then quantity, decides. Date, price and quantity are packed into one exact decimal so that the
    whole aggregate keeps fixed-width buffers (hash aggregation, no sort of the lines).
    """
    quantity, price = F.col("quantity"), F.col("ext_price")
    before, now = dates.in_prior(), dates.in_last()
    packed = (
        (F.unix_date("ship_date") + F.lit(1_000_000)).cast("decimal(7,0)") * F.lit(DATE_UNIT)
        + (price * F.lit(Decimal(10_000))).cast("decimal(18,0)") * F.lit(PRICE_UNIT)
        + quantity.cast("decimal(10,0)")
    ).cast("decimal(38,0)")
    windows = (
        lines.filter(F.col("is_financial") & dates.in_either())
        .groupBy("customer_id", "product_id")
        .agg(
            sum_when(before, F.col("gross_profit")).alias("gp_prior_12m"),
            sum_when(now, F.col("gross_profit")).alias("gp_last_12m"),
            sum_when(before, quantity).alias("units_prior_12m"),
            sum_when(now, quantity).alias("units_last_12m"),
            F.max(F.when(F.col("is_purchase"), F.col("ship_date"))).alias("last_purchase_date"),
            F.max(F.when(F.col("is_purchase") & (quantity > 0), packed)).alias("packed"),
        )
    )
    last = F.col("packed") % F.lit(DATE_UNIT)
    last_quantity = last % F.lit(PRICE_UNIT)
    last_price = ((last - last_quantity) / F.lit(PRICE_UNIT)).cast("decimal(18,0)").cast("double") / F.lit(10_000.0)
    brands = products.select("product_id", F.col("mapped_buy_line").alias("brand"), F.col("buy_line_desc").alias("brand_desc"))
    prior, recent = or_zero(F.col("gp_prior_12m")), or_zero(F.col("gp_last_12m"))
    return windows.join(brands, "product_id").select(
        "customer_id", "product_id", "brand", "brand_desc",
        prior.alias("gp_prior_12m"), recent.alias("gp_last_12m"),
        or_zero(F.col("units_prior_12m")).alias("units_prior_12m"),
        or_zero(F.col("units_last_12m")).alias("units_last_12m"),
        "last_purchase_date",
        (last_price / last_quantity.cast("double")).alias("last_unit_price"),
        has_dropped(prior, recent, cfg.min_product_profit, cfg.brand_drop_pct).alias("is_mostly_stopped"),
    )


def brand_changes(changes: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Customer x brand: the product changes rolled up, with the brand's own threshold."""
    rolled = changes.filter("brand is not null").groupBy("customer_id", "brand").agg(
        F.min("brand_desc").alias("brand_desc"),
        F.sum("gp_prior_12m").alias("gp_prior_12m"),
        F.sum("gp_last_12m").alias("gp_last_12m"),
        F.max("last_purchase_date").alias("last_purchase_date"),
    )
    stopped = has_dropped(F.col("gp_prior_12m"), F.col("gp_last_12m"), cfg.min_brand_profit, cfg.brand_drop_pct)
    return rolled.withColumn("is_mostly_stopped", stopped)


def customer_years(
    days: DataFrame, invoices: DataFrame, dates: ReportingDates, cfg: Settings = Settings()
) -> DataFrame:
    """Purchasing customer x calendar year, zeros included: full year and same-period figures.

    Years come from all transactions, stock moves included. The grid is the purchasers crossed with
    the calendar years in the data: a handful of rows, bounded by the calendar.
    """
    same = dates.in_same_period()
    yearly = days.groupBy("customer_id", F.year("ship_date").alias("sales_year")).agg(
        F.sum("sales").alias("full_sales"),
        F.sum("profit").alias("full_profit"),
        sum_when(same, F.col("sales")).alias("same_sales"),
        sum_when(same, F.col("profit")).alias("same_profit"),
    )
    counts = invoices.groupBy("customer_id", "sales_year").agg(F.count("*").alias("n_invoices"))
    years = F.broadcast(days.select(F.year("ship_date").alias("sales_year")).distinct())  # calendar years
    purchasers = days.filter("purchased").select("customer_id").distinct()
    keys = ["customer_id", "sales_year"]
    label = F.concat(F.lit("Jan 1 - "), F.date_format(dates.as_of_col, "MMM d"))
    return (
        purchasers.crossJoin(years).join(yearly, keys, "left").join(counts, keys, "left").select(
            F.concat("customer_id", F.lit("-"), F.col("sales_year").cast("string")).alias("customer_year_id"),
            F.lit(cfg.company_id).alias("company_id"),
            "customer_id", "sales_year",
            (F.col("sales_year") == F.year(dates.as_of_col)).alias("is_partial_year"),
            label.alias("same_period_label"),
            or_zero(F.col("full_sales")).alias("full_year_sales"),
            or_zero(F.col("full_profit")).alias("full_year_gross_profit"),
            or_zero(F.col("n_invoices")).alias("full_year_purchase_invoices"),
            or_zero(F.col("same_sales")).alias("same_period_sales"),
            or_zero(F.col("same_profit")).alias("same_period_gross_profit"),
        )
    )
