"""Business rules on lines and invoices, written once.

Money decides, text only labels: whether a line counts is read off price and cost, and the free
text of the customer PO picks the name of the line type, so a typo never moves a dollar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regain import config as c
from regain.config import Settings
from regain.functions.text import matches, upper_or_blank


def money_flags(sales: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Gross profit and the money-based flags of each line. Narrow.

    The text flag is a plain column, so plans that do not read it never run its patterns.
    """
    po = upper_or_blank("customer_po")
    return (
        sales.withColumn("gross_profit", F.col("ext_price") - F.col("ext_cogs"))
        .withColumn("is_financial", (F.col("ext_price") != 0) | (F.col("ext_cogs") != 0))
        .withColumn("is_purchase", F.col("ext_price") > 0)
        .withColumn("is_consignment", matches(po, cfg.consign_word) | matches(po, cfg.consign_abbreviation))
        # among lines carrying money a negative price comes first, so the flag needs no text
        .withColumn("is_return_credit", F.coalesce(F.col("ext_price") < 0, F.lit(False)))
    )


def classify_lines(sales: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Every line with its type (8 values), flags, profit and days from order to shipment."""
    lines = money_flags(sales, cfg)
    po = upper_or_blank("customer_po")
    not_financial = ~F.col("is_financial")
    line_type = (
        F.when(not_financial & F.col("is_consignment"), "consignment_transfer")
        .when(not_financial & matches(upper_or_blank("product_desc"), cfg.payment_word), "payment_record")
        .when(not_financial & matches(po, cfg.stock_move), "stock_transfer")
        .when(not_financial, "other_zero_dollar")
        .when(F.col("ext_price") < 0, "return_credit")
        .when(F.col("ext_price") == 0, "no_charge")
        .when(F.col("is_consignment"), "consignment_billing")
        .otherwise("sale")
    )
    return lines.select(
        "sales_line_id", "company_id", "invoice_no", "order_id", "bill_to_customer_id", "ship_to_customer_id",
        "product_id", "product_desc", "product_status", "sell_group", "outside_salesperson_id",
        "inside_salesperson_id", "writer_id", "price_branch_id", "ship_branch_id", "ship_via", "sales_source",
        "ship_date", "order_date", "required_date",
        F.datediff("ship_date", "order_date").alias("order_to_ship_days"),
        "quantity", "ext_price", "ext_cost", "ext_cogs", "gross_profit", "ext_weight", "customer_po",
        line_type.alias("line_type"),
        "is_financial", "is_consignment", "is_return_credit", "is_purchase",
        "is_direct_ship", "is_price_override", "is_cogs_override", "is_cost_override", "is_manual_override",
        "price_contract_id", "cost_contract_id", "_source_file", "_source_line",
    )


def reconcile_invoices(orders: DataFrame, lines: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Invoice headers beside the sum of their lines, with a reconciliation status.

    Lines are summed per invoice before the join (partial sums map-side), so an invoice holding a
    large share of all lines costs one row per task in the shuffle.
    """
    totals = lines.groupBy("invoice_no").agg(
        F.count("*").alias("line_count"),
        F.sum("ext_price").alias("line_price_total"),
        F.sum("ext_cogs").alias("line_cogs_total"),
    ).filter(F.col("invoice_no").isNotNull())
    gap = F.col("line_price_total") - F.col("item_total")
    status = (
        F.when(F.col("line_count").isNull(), "header_only")
        .when(F.abs(gap) <= F.lit(cfg.header_tolerance), "matched")
        .otherwise("variance")
    )
    return orders.join(totals, "invoice_no", "left").select(
        "invoice_no", "company_id", "bill_to_customer_id", "ship_to_customer_id", "outside_salesperson_id",
        "inside_salesperson_id", "price_branch_id", "ship_branch_id", "sales_source", "customer_po", "ship_date",
        F.col("item_count").alias("header_item_count"),
        F.col("item_total").alias("header_item_total"),
        F.col("cogs_total").alias("header_cogs_total"),
        "sales_tax", "freight_billed_out", "handling_billed_out",
        F.coalesce("line_count", F.lit(0)).alias("line_count"),
        "line_price_total", "line_cogs_total",
        gap.alias("line_variance"),
        status.alias("reconciliation_status"),
        "_source_file", "_source_line",
    )


def header_line_type(cfg: Settings = Settings()) -> Column:
    """Type of a header-only invoice: first matching rule wins."""
    po = upper_or_blank("customer_po")
    line_type = F.when(F.col("header_item_total") == 0, c.ZERO_TYPE)
    for pattern, name in cfg.header_patterns:
        hit = matches(po, pattern)
        if name == "service_charge":
            hit = (F.col("sales_source") == c.SERVICE_CHARGE_SOURCE) | hit
        line_type = line_type.when(hit, name)
    return line_type.otherwise(c.OTHER_HEADER_TYPE)


def classify_headers(invoices: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Headers without lines: what kind of money each is, in separate amount columns. Narrow."""
    total = F.col("header_item_total")
    kind = F.col("line_type")
    is_charge, is_rebate, is_zero = kind.isin(*c.CHARGE_TYPES), kind == c.REBATE_TYPE, kind == c.ZERO_TYPE
    nothing = F.lit(0).cast("decimal(18,4)")

    def amount_when(condition):
        return F.when(condition, total).otherwise(nothing)

    return (
        invoices.filter(F.col("reconciliation_status") == "header_only")
        .withColumn("line_type", header_line_type(cfg))
        .select(
            F.concat("invoice_no", F.lit(":header")).alias("sales_line_id"),
            "company_id", "invoice_no", "bill_to_customer_id", "ship_to_customer_id", "outside_salesperson_id",
            "inside_salesperson_id", "price_branch_id", "ship_branch_id", "sales_source", "customer_po", "ship_date",
            "line_type",
            F.when(is_charge, "charge").when(is_zero, "zero_dollar").otherwise("adjustment").alias("entry_group"),
            amount_when(is_charge).alias("charge_amount"),
            amount_when(is_rebate).alias("rebate_amount"),
            amount_when(~(is_charge | is_rebate | is_zero)).alias("adjustment_amount"),
            F.col("header_cogs_total").alias("header_cogs"),
            (total != 0).alias("is_financial"),
            "_source_file", "_source_line",
        )
    )


def invoice_corrections(invoices: DataFrame) -> DataFrame:
    """One row per invoice whose lines disagree with the header: header minus lines. Narrow.

    The header columns ride along, so sales detail needs no second join to the invoices.
    """
    price = F.col("header_item_total") - F.col("line_price_total")
    cogs = F.col("header_cogs_total") - F.col("line_cogs_total")
    return invoices.filter(F.col("reconciliation_status") == "variance").select(
        F.concat("invoice_no", F.lit(":correction")).alias("transaction_id"),
        "company_id", "invoice_no", "bill_to_customer_id", "ship_to_customer_id", "outside_salesperson_id",
        "inside_salesperson_id", "price_branch_id", "ship_branch_id", "sales_source", "customer_po", "ship_date",
        price.alias("ext_price"), cogs.alias("ext_cogs"), (price - cogs).alias("gross_profit"),
        "_source_file", "_source_line",
    )


COMMON = ("company_id", "bill_to_customer_id", "invoice_no", "ship_date")


def _owned(rows: DataFrame, remap: DataFrame) -> DataFrame:
    """Add the customer: the bill-to account, or the customer it belongs to.

    ``remap`` holds only accounts that belong to another customer (a reviewed list), so most rows
    find no partner. Spark broadcasts it when its size allows; beyond that the adaptive skew join
    splits a heavy bill-to account.
    """
    owner = remap.select(F.col("account_id").alias("bill_to_customer_id"), F.col("customer_id").alias("owner_id"))
    return (
        rows.join(owner, "bill_to_customer_id", "left")
        .withColumn("customer_id", F.coalesce("owner_id", "bill_to_customer_id"))
        .drop("owner_id")
    )


def line_transactions(lines: DataFrame, remap: DataFrame) -> DataFrame:
    """Product lines under the customer's own id. Quantity rides along, so product windows need no
    join back to the lines."""
    rows = lines.select(
        F.col("sales_line_id").alias("transaction_id"), *COMMON, F.lit("product_line").alias("transaction_type"),
        "product_id", "quantity", "ext_price", "ext_cogs", "gross_profit",
        "is_financial", "is_purchase", "is_return_credit", "is_consignment",
    )
    return _owned(rows, remap)


def exception_transactions(invoices: DataFrame, remap: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """What the invoices add to the lines: corrections (header minus lines) and rebates.

    One pass over the invoices for both; neither is ever a purchase or a return.
    """
    is_fix = F.col("reconciliation_status") == "variance"
    is_rebate = (F.col("reconciliation_status") == "header_only") & (header_line_type(cfg) == c.REBATE_TYPE)
    total = F.col("header_item_total")
    price = F.when(is_fix, total - F.col("line_price_total")).otherwise(total)
    cogs = F.when(is_fix, F.col("header_cogs_total") - F.col("line_cogs_total")).otherwise(F.lit(0))
    no = F.lit(False)
    rows = invoices.filter(is_fix | is_rebate).select(
        F.concat("invoice_no", F.when(is_fix, ":correction").otherwise(":header")).alias("transaction_id"),
        *COMMON,
        F.when(is_fix, "invoice_correction").otherwise("rebate").alias("transaction_type"),
        price.alias("ext_price"), cogs.alias("ext_cogs"), (price - cogs).alias("gross_profit"),
        F.lit(True).alias("is_financial"), no.alias("is_purchase"), no.alias("is_return_credit"), no.alias("is_consignment"),
    )
    return _owned(rows, remap)


def customer_transactions(of_lines: DataFrame, of_exceptions: DataFrame) -> DataFrame:
    """Everything that counts towards a customer's sales and profit."""
    return of_lines.unionByName(of_exceptions, allowMissingColumns=True)
