"""Customers, salespeople, brands, products and stock: the small side of the model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regain.config import Settings


def customer_groups(customers: DataFrame, seed: DataFrame) -> DataFrame:
    """Every account with the customer it belongs to (itself unless the seed says otherwise)."""
    links = seed.select(
        F.col("customer_id").alias("account_id"), "group_customer_id", F.col("reason").alias("grouping_reason")
    )
    return customers.select(F.col("customer_id").alias("account_id"), "company_id").join(links, "account_id", "left").select(
        "account_id", "company_id", F.coalesce("group_customer_id", "account_id").alias("customer_id"), "grouping_reason"
    )


def account_remap(customers: DataFrame, seed: DataFrame) -> DataFrame:
    """Only the accounts that belong to another customer: the seed rows found in the master."""
    return (
        seed.select(F.col("customer_id").alias("account_id"), F.col("group_customer_id").alias("customer_id"))
        .filter("customer_id is not null")
        .join(customers.select(F.col("customer_id").alias("account_id")), "account_id", "left_semi")
    )


def map_buylines(lookup: DataFrame, products: DataFrame, seed: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Brand codes, in the lookup or only seen on products; only high-confidence pairs are merged."""
    known = lookup.select("buy_line", "buy_line_desc", F.lit(True).alias("is_in_lookup"))
    unknown = (
        products.select("buy_line").filter("buy_line is not null").distinct()
        .join(lookup.select("buy_line"), "buy_line", "left_anti")
        .withColumn("is_in_lookup", F.lit(False))
    )
    return known.unionByName(unknown, allowMissingColumns=True).join(seed, "buy_line", "left").select(
        "buy_line",
        F.lit(cfg.company_id).alias("company_id"),
        F.coalesce("buy_line_desc", "buy_line").alias("buy_line_desc"),
        "is_in_lookup",
        F.when(F.col("confidence") == "high", F.col("mapped_buy_line")).otherwise(F.col("buy_line")).alias("mapped_buy_line"),
        F.col("confidence").alias("mapping_confidence"),
        F.col("note").alias("mapping_note"),
    )


def resolve_salespeople(
    lookup: DataFrame, sales: DataFrame, customers: DataFrame, system_accounts: DataFrame, cfg: Settings = Settings()
) -> DataFrame:
    """Salesperson id -> person. Ids with the same name are one person, the most used id leads.

    The leading id is an aggregate joined back rather than a window, so a name shared by very many
    ids is never sorted in one task.
    """
    # the few distinct pairs of ids are counted before the two ids are unfolded
    pairs = sales.groupBy("outside_salesperson_id", "inside_salesperson_id").agg(F.count("*").alias("n"))
    line_ids = pairs.select(F.explode(F.array("outside_salesperson_id", "inside_salesperson_id")).alias("salesperson_id"), "n")
    assigned = customers.groupBy("salesperson_id").agg(F.count("*").alias("n"))
    usage = (
        line_ids.unionByName(assigned).filter("salesperson_id is not null")
        .groupBy("salesperson_id").agg(F.sum("n").alias("uses"))
    )
    # one pass over the usage: an id outside the lookup arrives from the right side of the join
    listed = lookup.select("salesperson_id", "salesperson_name", F.lit(True).alias("is_in_lookup"))
    ids = (
        listed.join(usage, "salesperson_id", "full_outer")
        .withColumn("is_in_lookup", F.coalesce("is_in_lookup", F.lit(False)))
        .withColumn("uses", F.coalesce("uses", F.lit(0)))
        .withColumn("person_key", F.coalesce(F.upper("salesperson_name"), "salesperson_id"))
    )
    leaders = ids.groupBy("person_key").agg(
        F.min_by(
            F.struct(F.col("salesperson_id").alias("person_id"), F.col("salesperson_name").alias("person_name")),
            F.struct(-F.col("uses"), F.col("salesperson_id")),
        ).alias("leader")
    )
    system = system_accounts.select("salesperson_id", F.lit(True).alias("listed_system")).distinct()
    return ids.join(leaders, "person_key", "left").join(system, "salesperson_id", "left").select(
        "salesperson_id",
        F.lit(cfg.company_id).alias("company_id"),
        "salesperson_name",
        F.col("leader.person_id").alias("person_id"),
        F.col("leader.person_name").alias("person_name"),
        F.coalesce("listed_system", F.lit(False)).alias("is_system_account"),
        "is_in_lookup",
        F.col("uses").alias("usage_count"),
    )


def collapse_products(products: DataFrame, gltypes: DataFrame, buylines: DataFrame) -> DataFrame:
    """One row per SKU: the first branch's row, with type and brand names.

    Rows are exchanged before they are sorted: what a task sorts is a share of the exchange, of bounded size, and not all
    the rows of its split, which for a well-compressed master are millions.
    """
    first = Window.partitionBy("product_id").orderBy(F.col("branch_id").asc_nulls_last())
    one = products.repartition("product_id").withColumn("n", F.row_number().over(first)).filter("n = 1")
    types = gltypes.select("gl_type", "gl_type_desc")
    brands = buylines.select("buy_line", "mapped_buy_line", "buy_line_desc")
    return one.join(types, "gl_type", "left").join(brands, "buy_line", "left").select(
        "product_id", "company_id", "product_desc", "product_desc_2", "gl_type", "gl_type_desc", "buy_line",
        "mapped_buy_line", "buy_line_desc", "price_line", "is_non_product", "product_status", "commodity_code",
        "select_code", "is_kit", "keywords", "upc", "mfr_catalog_no",
    )


def inventory_by_branch(inventory: DataFrame) -> DataFrame:
    """Stock per product and branch: warehouse, at customer sites, other; demand; bins."""
    kind = F.col("stock_type")
    warehouse, consigned = kind == "S", kind.startswith("C")
    other = (kind != "S") & ~kind.startswith("C")

    def total(condition, column):
        return F.sum(F.when(condition, F.col(column)))

    def warehouse_max(column):
        return F.max(F.when(warehouse, F.col(column))).alias(column)

    # bins are few per product and branch; the text lists them all
    bins = inventory.filter(warehouse & F.col("bin_location").isNotNull()).groupBy("product_id", "branch_id").agg(
        F.expr("listagg(bin_location, ', ') within group (order by bin_location)").alias("warehouse_bin_locations")
    )
    sites = (
        inventory.filter(consigned).groupBy("product_id", "branch_id", "stock_type").agg(F.lit(1).alias("one"))
        .groupBy("product_id", "branch_id").agg(F.count("*").alias("consignment_customer_count"))
    )
    stock = inventory.groupBy("product_id", "branch_id").agg(
        F.min("as_of_date").alias("as_of_date"),
        total(warehouse, "onhand_qty").alias("warehouse_qty"),
        total(consigned, "onhand_qty").alias("consignment_qty"),
        total(other, "onhand_qty").alias("other_qty"),
        F.sum("onhand_qty").alias("total_onhand_qty"),
        total(warehouse, "ext_cogs").alias("warehouse_value"),
        F.sum("ext_cogs").alias("total_value"),
        warehouse_max("committed_qty"),
        warehouse_max("demand_per_month"),
        warehouse_max("sales_365_days"),
        warehouse_max("hits_365_days"),
    )
    keys = ["product_id", "branch_id"]

    def same(right):
        return [F.col(f"s.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]

    return (
        stock.alias("s").join(sites.alias("c"), same("c"), "left").join(bins.alias("b"), same("b"), "left")
        .select(
            "s.*",
            F.coalesce("consignment_customer_count", F.lit(0)).alias("consignment_customer_count"),
            "warehouse_bin_locations",
        )
    )


def inventory_mart(stock: DataFrame, products: DataFrame, branches: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Stock per product and branch with names; available = warehouse minus committed."""
    names = products.select(
        "product_id", "product_desc", F.col("gl_type_desc").alias("product_type_desc"), F.col("mapped_buy_line").alias("brand")
    )
    held = F.coalesce("warehouse_qty", F.lit(0))
    return stock.join(names, "product_id", "left").join(branches.select("branch_id", "branch_name"), "branch_id", "left").select(
        F.concat("product_id", F.lit("-"), "branch_id").alias("product_branch_id"),
        F.lit(cfg.company_id).alias("company_id"),
        "product_id", "product_desc", "product_type_desc", "brand", "branch_id", "branch_name", "as_of_date",
        held.alias("warehouse_qty"),
        F.coalesce("consignment_qty", F.lit(0)).alias("consignment_qty"),
        F.coalesce("other_qty", F.lit(0)).alias("other_qty"),
        "committed_qty",
        (held - F.coalesce("committed_qty", F.lit(0))).alias("available_qty"),
        "warehouse_value", "warehouse_bin_locations", "consignment_customer_count", "demand_per_month",
        F.col("sales_365_days").alias("erp_units_sold_365_days"),
        F.col("hits_365_days").alias("erp_order_hits_365_days"),
    )
