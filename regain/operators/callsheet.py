"""The call sheet: what to talk about with each customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regain import config as c
from regain.config import Settings
from regain.functions.numbers import or_zero, round_half_away, safe_div
from regain.operators.windows import ReportingDates


def product_prices(lines: DataFrame, dates: ReportingDates) -> DataFrame:
    """Typical unit price per product over the last 12 months; the same figure as in the product mart."""
    recent = lines.filter(F.col("is_purchase") & dates.in_last())
    sums = recent.groupBy("product_id").agg(F.sum("ext_price").alias("price"), F.sum("quantity").alias("units"))
    return sums.select("product_id", safe_div(F.col("price"), F.col("units")).alias("avg_unit_price_last_12m"))


def product_stock(inventory: DataFrame) -> DataFrame:
    """Per product: available over all branches, and the branch with the most (lowest id on a tie)."""
    named = F.col("branch_name").isNotNull()
    best = F.struct(-F.col("available_qty"), F.col("branch_id"))
    return inventory.groupBy("product_id").agg(
        F.sum("available_qty").alias("available_all_branches"),
        F.min_by(F.when(named, F.col("branch_name")), F.when(named, best)).alias("best_branch"),
        F.max("available_qty").alias("best_branch_available"),
    )


def call_sheet(
    changes: DataFrame, homes: DataFrame, catalogue: DataFrame, inventory: DataFrame, cfg: Settings = Settings()
) -> DataFrame:
    """Customer x product mostly stopped: status, rank, past buying, last price, price and stock now.

    ``homes`` gives each customer's home branch, ``catalogue`` each product's names and current price. Ranks are a window
    per customer: it holds a product once, so a customer is bounded by the catalogue, not by its lines.
    """
    stopped = changes.filter("is_mostly_stopped")
    stock = product_stock(inventory)
    at_home = inventory.select(
        "product_id", F.col("branch_id").alias("home_branch_id"), F.col("available_qty").alias("at_home")
    )
    price = F.col("avg_unit_price_last_12m")
    available = or_zero(F.col("available_all_branches"))
    status = (
        F.when(price.isNull(), c.STATUS_REPLACED).when(available > 0, c.STATUS_IN_STOCK).otherwise(c.STATUS_NOT_IN_STOCK)
    )
    order = F.when(price.isNull(), 3).when(available > 0, 1).otherwise(2)
    rows = (
        stopped.join(homes.select("customer_id", "home_branch_id", "home_branch_name"), "customer_id")
        .join(catalogue.select("product_id", "product_desc", "product_type_desc", "avg_unit_price_last_12m"), "product_id", "left")
        .join(stock, "product_id", "left")
        .join(at_home, ["product_id", "home_branch_id"], "left")
        .select(
            F.concat("customer_id", F.lit("-"), "product_id").alias("call_sheet_id"),
            F.lit(cfg.company_id).alias("company_id"),
            "customer_id", "product_id", "product_desc", "product_type_desc", "brand", "brand_desc",
            status.alias("status"), order.alias("_order"),
            "gp_prior_12m", "gp_last_12m", "units_prior_12m", "units_last_12m",
            round_half_away(F.col("units_prior_12m").cast("double") / F.lit(12.0), 1).alias("avg_units_per_month_before"),
            "last_purchase_date", "last_unit_price", price.alias("current_typical_price"),
            or_zero(F.col("at_home")).alias("available_home_branch"), "home_branch_name",
            available.alias("available_all_branches"),
            F.when(or_zero(F.col("best_branch_available")) > 0, F.col("best_branch")).alias("best_branch"),
            or_zero(F.col("best_branch_available")).alias("best_branch_available"),
        )
    )
    best_first = Window.partitionBy("customer_id").orderBy("_order", F.col("gp_prior_12m").desc(), "product_id")
    return rows.withColumn("product_rank", F.row_number().over(best_first).cast("bigint")).drop("_order")
