"""Adapter: the TPC-H-like sample tables seen as the distributor's staging tables.

All derivations are integer or decimal arithmetic on existing columns, so any engine can repeat
them. ``stg_*`` methods give the typed tables the operators read; ``raw_*`` methods render the
same rows as untyped, untidy text for the staging functions to clean.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regain.config import Settings

LOADED_AT = "2002-01-01 00:00:00"
INVENTORY_DATE = "2001-11-04"
MONEY = "decimal(18,4)"
# what the tables made of lines read of them
LINE_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_linestatus", "o_custkey", "o_orderdate", "sign",
    "ship_date", "price", "cogs",
)


def _text(col) -> Column:
    return F.col(col).cast("string") if isinstance(col, str) else col.cast("string")


def _customer_rep(key: Column, nation: Column) -> Column:
    return (
        F.when(key % 7 == 0, F.lit(None).cast("string"))
        .when(key % 11 == 0, F.lit("HSE"))
        .otherwise(F.concat(F.lit("SP"), nation.cast("string")))
    )


@dataclass(frozen=True)
class SampleTables:
    spark: SparkSession
    path: str
    settings: Settings = Settings()
    keep: Callable[[DataFrame], DataFrame] | None = None  # writes what several tables are derived from

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    def _dealt(self, name: str, key: str) -> DataFrame:
        """A table of few bytes and many rows dealt to tasks: one task reads all of it, and would make all that is made of it. By range:
        rows near each other stay so, and their files take no more."""
        return self._table(name).repartitionByRange(key)

    @cached_property
    def _lineitem(self) -> DataFrame:
        return self._table("lineitem")

    def _company(self) -> Column:
        return F.lit(self.settings.company_id)

    def _loaded(self) -> Column:
        return F.lit(LOADED_AT).cast("timestamp")

    # ---- invoice lines ----------------------------------------------------------------------

    @cached_property
    def _joined_lines(self) -> DataFrame:
        # some lines occur twice, and some consignment transfers come back: copies under line numbers of their own
        number, free = F.col("l_linenumber"), (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13 + F.col("l_partkey")) % 100 < 25
        once = self._lineitem
        again = once.filter((F.col("l_orderkey") % 97 == 0) & (number == 1)).withColumn("l_linenumber", (number + 300).cast("int"))
        back = once.filter((F.col("l_orderkey") % 19 == 0) & free).withColumns(
            {"l_linenumber": (number + 600).cast("int"), "l_quantity": -F.col("l_quantity")}
        )
        line = once.unionByName(again).unionByName(back)
        order = self._table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        cust, ship = F.col("o_custkey"), F.col("l_shipdate").cast("date")
        code = (
            F.when(cust % 50 == 7, 0)
            .when((cust % 40 == 3) & (ship >= F.lit("1999-01-01").cast("date")), 0)
            .when((cust % 40 == 5) & (ship >= F.lit("2000-10-01").cast("date")), 0)
            .otherwise((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13 + F.col("l_partkey")) % 100)
        )
        rate = (F.lit(0.70) + F.col("l_discount")).cast("decimal(4,2)")
        base = F.col("l_extendedprice").cast(MONEY)
        joined = (
            line.join(order, line.l_orderkey == order.o_orderkey, "left")
            .withColumn("code", code)
            .withColumn("sign", F.when((F.col("l_returnflag") == "R") & (F.col("code") >= 90), -1).otherwise(1))
            .withColumn("ship_date", ship)
            .withColumn("price", F.when(F.col("code") < 30, F.lit(0).cast(MONEY)).otherwise((F.col("sign") * base).cast(MONEY)))
            .withColumn(
                "cogs",
                F.when(F.col("code") < 25, F.lit(0).cast(MONEY)).otherwise((F.col("sign") * (base * rate).cast(MONEY)).cast(MONEY)),
            )
        )
        return joined if self.keep is None else self.keep(joined.select(*LINE_COLUMNS))

    def _line_columns(self) -> dict[str, Column]:
        supp = F.col("l_suppkey")
        po = [
            F.lit("Consignment bill"), F.lit("CON T 4/21"), F.lit("CONSTRUCTION JOB"),
            F.concat(F.lit("PO "), _text("l_orderkey")), F.lit("WH STOCK TRANSFER"), F.lit("RETURN"),
            F.lit("JOB 7"), F.lit("COSINGMENT"),
        ]
        customer_po = F.lit(None).cast("string")
        for i, value in enumerate(po):
            customer_po = F.when(supp % 10 == i, value).otherwise(customer_po)
        return {
            "sales_line_id": F.concat_ws(
                ":", _text("l_orderkey"), _text("l_linenumber"), _text("l_partkey"), _text("l_suppkey"),
                _text(F.col("l_quantity").cast("int")), _text("ship_date"),
            ),
            "company_id": self._company(),
            "invoice_no": _text("l_orderkey"),
            "order_id": F.concat(F.lit("SO"), _text("l_orderkey")),
            "bill_to_customer_id": _text("o_custkey"),
            "ship_to_customer_id": _text(F.greatest(F.col("o_custkey") - supp % 2, F.lit(0))),
            "product_id": _text("l_partkey"),
            "product_status": F.when(F.col("l_partkey") % 9 == 0, "D").otherwise("A"),
            "sell_group": F.concat(F.lit("SG"), _text(supp % 3)),
            "inside_salesperson_id": F.concat(F.lit("SP"), _text(supp % 25)),
            "writer_id": F.concat(F.lit("W"), _text(supp % 4)),
            "price_branch_id": _text(supp % 5),
            "ship_branch_id": _text(supp % 5),
            "ship_via": F.when(supp % 2 == 0, "TRUCK").otherwise("PICKUP"),
            "sales_source": F.element_at(
                F.array(F.lit("CTR"), F.lit("INS"), F.lit("OUT")), (F.col("l_linenumber") % 3 + 1).cast("int")
            ),
            "order_status": F.col("l_linestatus"),
            "ship_date": F.col("ship_date"),
            "order_date": F.col("o_orderdate").cast("date"),
            "required_date": F.date_add(F.col("o_orderdate").cast("date"), 30),
            "quantity": (F.col("sign") * F.col("l_quantity").cast("int")).cast("int"),
            "ext_price": F.col("price"),
            "ext_cost": (F.col("cogs") * F.lit(2)).cast(MONEY),
            "ext_cogs": F.col("cogs"),
            "ext_price_change": F.lit(0).cast(MONEY),
            "ext_weight": (F.col("l_quantity").cast("int") * 3).cast(MONEY),
            "customer_po": customer_po,
            "is_direct_ship": F.col("l_linestatus") == "O",
            "is_price_override": supp % 6 == 0,
            "is_cogs_override": supp % 7 == 0,
            "is_cost_override": supp % 8 == 0,
            "is_manual_override": F.when(supp % 3 == 0, F.lit(True)).when(supp % 3 == 1, F.lit(False)),
            "override_sign": F.lit("+"),
            "cost_flag": F.lit("C"),
            "cost_contract_id": F.concat(F.lit("CC"), _text(supp % 11)),
            "price_flag": F.lit("P"),
            "price_contract_id": F.concat(F.lit("PC"), _text(supp % 13)),
            "_source_file": F.concat(F.lit("sales_"), _text(F.year("ship_date")), F.lit(".txt")),
            "_source_line": (F.col("l_orderkey") % 10000000 * 10 + F.col("l_linenumber")).cast("bigint"),
            "_loaded_at": self._loaded(),
        }

    @cached_property
    def stg_sales_core(self) -> DataFrame:
        """Invoice lines without the two columns that need the product and customer tables."""
        return self._joined_lines.select(*[c.alias(n) for n, c in self._line_columns().items()])

    @cached_property
    def stg_sales(self) -> DataFrame:
        part = self._table("part").select("p_partkey", "p_name")
        customer = self._table("customer").select("c_custkey", "c_nationkey")
        lines = self._joined_lines
        lines = lines.join(part, lines.l_partkey == part.p_partkey, "left").join(
            customer, lines.o_custkey == customer.c_custkey, "left"
        )
        columns = self._line_columns()
        columns["product_desc"] = F.when(F.col("l_partkey") % 50 == 0, "ONLINE PAYMENT").otherwise(F.col("p_name"))
        columns["outside_salesperson_id"] = _customer_rep(F.col("o_custkey"), F.col("c_nationkey"))
        return lines.select(*[c.alias(n) for n, c in columns.items()])

    # ---- invoice headers --------------------------------------------------------------------

    @cached_property
    def stg_orders(self) -> DataFrame:
        key = F.col("o_orderkey")

        def sums(lines: DataFrame, key: str, price: str, cogs: str) -> DataFrame:
            return lines.groupBy(key).agg(F.count("*").alias("n"), F.sum(price).alias("line_price"), F.sum(cogs).alias("line_cogs"))

        orders = self._table("orders").withColumn("invoice_no", _text("o_orderkey"))
        if self.keep is None:  # the lines still lie by order, as they were joined
            totals = sums(self._joined_lines, "l_orderkey", "price", "cogs")
            found = orders.join(totals, orders.o_orderkey == totals.l_orderkey, "left")
        else:  # by invoice, as invoices are joined to their lines: sums and orders are exchanged once for both
            totals = sums(self.stg_sales_core, "invoice_no", "ext_price", "ext_cogs").filter(F.col("invoice_no").isNotNull())
            found = orders.join(totals, "invoice_no", "left")
        header_sign = F.when(key % 11 == 0, 0).when(key % 2 == 0, -1).otherwise(1)
        item_total = (
            F.when(F.col("n").isNull(), (F.col("o_totalprice").cast(MONEY) * header_sign).cast(MONEY))
            .when(key % 10 == 0, (F.col("line_price") - 5).cast(MONEY))
            .when(key % 10 == 1, (F.col("line_price") + F.lit("0.01").cast("decimal(3,2)")).cast(MONEY))
            .otherwise(F.col("line_price").cast(MONEY))
        )
        texts = ["SERVICE CHG", "FUEL SURCHARGE", "PRE-BUY", "LOYALTY REBATE", "BAD DEBT", "AR ADJ", "ACH RETURN", "DONATION"]
        po = F.lit(None).cast("string")
        for i, value in enumerate(texts):
            po = F.when(key % 9 == i, F.lit(value)).otherwise(po)
        zero = F.lit(0).cast(MONEY)
        source = F.element_at(F.array(F.lit("CTR"), F.lit("INS"), F.lit("OUT")), (key % 3 + 1).cast("int"))
        return found.select(
            "invoice_no",
            self._company().alias("company_id"),
            _text("o_custkey").alias("bill_to_customer_id"),
            _text("o_custkey").alias("ship_to_customer_id"),
            F.concat(F.lit("SP"), _text(key % 25)).alias("outside_salesperson_id"),
            F.concat(F.lit("SP"), _text(key % 20)).alias("inside_salesperson_id"),
            F.concat(F.lit("W"), _text(key % 4)).alias("writer_id"),
            _text(key % 5).alias("price_branch_id"),
            _text(key % 5).alias("ship_branch_id"),
            F.lit("TRUCK").alias("ship_via"),
            F.when(key % 13 == 0, "SR").otherwise(source).alias("sales_source"),
            F.concat(F.lit("M"), _text(key % 100)).alias("manifest_no"),
            po.alias("customer_po"),
            F.col("o_orderdate").cast("date").alias("ship_date"),
            F.coalesce(F.col("n"), F.lit(0)).cast("int").alias("item_count"),
            item_total.alias("item_total"),
            F.coalesce(F.col("line_cogs"), F.lit(0)).cast(MONEY).alias("cost_total"),
            F.coalesce(F.col("line_cogs"), F.lit(0)).cast(MONEY).alias("cogs_total"),
            (key % 50).cast(MONEY).alias("sales_tax"),
            zero.alias("freight_billed_in"),
            (key % 20).cast(MONEY).alias("freight_billed_out"),
            zero.alias("freight_expense_in"),
            (key % 15).cast(MONEY).alias("freight_expense_out"),
            zero.alias("handling_billed_in"),
            (key % 5).cast(MONEY).alias("handling_billed_out"),
            zero.alias("handling_expense_in"),
            zero.alias("handling_expense_out"),
            F.concat(F.lit("orders_"), _text(F.year("o_orderdate")), F.lit(".txt")).alias("_source_file"),
            (key % 100000000 + 2).cast("bigint").alias("_source_line"),
            self._loaded().alias("_loaded_at"),
        )

    # ---- masters and lookups ----------------------------------------------------------------

    @cached_property
    def stg_customers(self) -> DataFrame:
        key = F.col("c_custkey")
        nation = self._table("nation").select("n_nationkey", "n_regionkey")
        customer = self._table("customer")
        name = F.when(key % 20 == 19, F.concat(F.lit("Customer#"), F.lpad(_text(key - 1), 9, "0"), F.lit(" (non tax)"))).otherwise(
            F.col("c_name")
        )
        return customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").select(
            _text("c_custkey").alias("customer_id"),
            self._company().alias("company_id"),
            _text("c_custkey").alias("bill_to_customer_id"),
            name.alias("customer_name"),
            F.concat(_text("c_custkey"), F.lit(" Main St")).alias("address_1"),
            F.lit(None).cast("string").alias("address_2"),
            F.concat(F.lit("City "), _text("c_nationkey")).alias("city"),
            F.concat(F.lit("S"), _text("n_regionkey")).alias("state"),
            F.lpad(_text(key % 100000), 5, "0").alias("zip"),
            F.concat(F.lit("555-"), F.lpad(_text(key % 10000), 4, "0")).alias("phone"),
            F.lit(None).cast("string").alias("fax"),
            F.when(key % 3 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("c"), _text("c_custkey"), F.lit("@example.com"))).alias("email"),
            _customer_rep(key, F.col("c_nationkey")).alias("salesperson_id"),
            F.concat(F.lit("SP"), _text(key % 25)).alias("inside_salesperson_id"),
            _text("n_regionkey").alias("home_branch_id"),
            F.col("c_mktsegment").alias("customer_type"),
            F.concat(F.lit("K"), _text(key % 4)).alias("customer_class"),
            F.when(key % 2 == 0, "NET30").otherwise("COD").alias("terms_code"),
            (key % 6 == 0).alias("is_inactive"),
            F.date_add(F.lit("2001-01-01").cast("date"), (key % 300).cast("int")).alias("last_payment_date"),
            F.col("c_acctbal").cast(MONEY).alias("last_payment_amount"),
            (key % 10 * 1000).cast(MONEY).alias("credit_limit"),
            (key % 7 * 100).cast(MONEY).alias("credit_used"),
            (key % 60).cast("int").alias("avg_debtor_days"),
            F.lit("custdata.txt").alias("_source_file"),
            (key % 100000000 + 2).cast("bigint").alias("_source_line"),
            self._loaded().alias("_loaded_at"),
        )

    @cached_property
    def stg_branches(self) -> DataFrame:
        return self._table("region").select(
            _text("r_regionkey").alias("branch_id"),
            self._company().alias("company_id"),
            F.substring("r_name", 1, 3).alias("branch_short_name"),
            F.col("r_name").alias("branch_name"),
        )

    @cached_property
    def stg_gltypes(self) -> DataFrame:
        return (
            self._table("part")
            .filter(F.col("p_type") != "PROMO")
            .select(
                F.col("p_type").alias("gl_type"),
                self._company().alias("company_id"),
                F.concat(F.col("p_type"), F.lit(" goods")).alias("gl_type_desc"),
            )
            .distinct()
        )

    @cached_property
    def stg_buylines(self) -> DataFrame:
        code = F.col("p_brand")
        desc = F.when(code == "Brand#2", F.lit("Line 1")).otherwise(F.concat(F.lit("Line "), F.substring(code, 7, 10)))
        return (
            self._table("part")
            .filter(~code.isin("Brand#7", "Brand#13"))
            .select(code.alias("buy_line"), self._company().alias("company_id"), desc.alias("buy_line_desc"))
            .distinct()
        )

    @cached_property
    def stg_salespeople(self) -> DataFrame:
        key = F.col("n_nationkey")
        name = F.concat(F.lit("Rep "), _text(key % 20))
        people = self._table("nation").filter(key != 24).select(
            F.concat(F.lit("SP"), _text("n_nationkey")).alias("salesperson_id"),
            self._company().alias("company_id"),
            F.when(key >= 20, F.upper(name)).otherwise(name).alias("salesperson_name"),
        )
        house = self.spark.range(1).select(
            F.lit("HSE").alias("salesperson_id"), self._company().alias("company_id"), F.lit("House Account").alias("salesperson_name")
        )
        return people.unionByName(house)

    @cached_property
    def stg_products(self) -> DataFrame:
        key, region = F.col("p_partkey"), F.col("r_regionkey")
        gl_type = F.when(key % 97 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type"))
        regions = F.broadcast(self._table("region").select("r_regionkey"))  # five branches
        return self._dealt("part", "p_partkey").crossJoin(regions).select(
            F.concat(_text("p_partkey"), F.lit("-"), _text("r_regionkey")).alias("product_branch_id"),
            self._company().alias("company_id"),
            _text("p_partkey").alias("product_id"),
            _text("r_regionkey").alias("branch_id"),
            F.col("p_name").alias("product_desc"),
            F.concat(F.lit("size "), _text("p_size")).alias("product_desc_2"),
            F.col("p_brand").alias("buy_line"),
            F.concat(F.lit("PL"), _text(key % 8)).alias("price_line"),
            gl_type.alias("gl_type"),
            ((F.col("p_type") == "PROMO") | (key % 97 == 0)).alias("is_non_product"),
            F.when(key % 9 == 0, "D").otherwise("A").alias("product_status"),
            F.lit(None).cast("string").alias("select_code"),
            F.concat(F.lit("CM"), _text(key % 5)).alias("commodity_code"),
            (key % 12 == 0).alias("is_kit"),
            F.col("p_name").alias("keywords"),
            F.lpad(_text("p_partkey"), 12, "0").alias("upc"),
            F.concat(F.lit("MFR"), _text("p_partkey")).alias("mfr_catalog_no"),
            F.lit(None).cast("string").alias("related_products"),
            (key % 6 + region).cast("int").alias("buy_pack"),
            F.lit("Units").alias("target_type"),
            (key % 40).cast("int").alias("target"),
            F.lit("proddata -.txt").alias("_source_file"),
            (key % 100000000 * 5 + region + 2).cast("bigint").alias("_source_line"),
            self._loaded().alias("_loaded_at"),
        )

    @cached_property
    def stg_inventory(self) -> DataFrame:
        key, region = F.col("p_partkey"), F.col("r_regionkey")
        null_int = F.lit(None).cast("int")

        def bucket(no, keep, stock_type, onhand, committed, demand):
            return F.when(
                keep,
                F.struct(
                    F.lit(no).alias("no"), stock_type.alias("stock_type"), onhand.cast("int").alias("onhand"),
                    committed.cast("int").alias("committed"), demand.cast("int").alias("demand"),
                ),
            )

        stocked = ((key + region) % 3 < 2) & (key % 6 < 4)
        buckets = F.array(
            bucket(1, stocked, F.lit("S"), (key * 7 + region) % 50, F.nullif((key + region) % 12, F.lit(0)), key % 30),
            bucket(2, stocked & (key % 10 == 0), F.lit("S"), F.lit(3), null_int, null_int),
            bucket(3, (key % 4 == 0) & (region == 0), F.concat(F.lit("C"), _text(key % 100)), F.lit(5), null_int, null_int),
            bucket(4, (key % 25 == 0) & (region == 1), F.lit("F"), F.lit(1), null_int, null_int),
        )
        regions = F.broadcast(self._table("region").select("r_regionkey"))  # five branches
        rows = self._dealt("part", "p_partkey").crossJoin(regions).select("*", F.explode(F.array_compact(buckets)).alias("b"))
        onhand = F.col("b.onhand")
        unit = F.col("p_retailprice").cast(MONEY)
        return rows.select(
            F.concat(F.lit("invendata.txt:"), _text(key * 20 + region * 4 + F.col("b.no"))).alias("inventory_row_id"),
            self._company().alias("company_id"),
            _text("p_partkey").alias("product_id"),
            _text("r_regionkey").alias("branch_id"),
            F.concat(F.lit("B"), _text(key % 17), F.lit("-"), _text(F.col("b.no"))).alias("bin_location"),
            F.lit(INVENTORY_DATE).cast("date").alias("as_of_date"),
            F.col("p_brand").alias("buy_line"),
            F.concat(F.lit("PL"), _text(key % 8)).alias("price_line"),
            F.col("p_type").alias("gl_type"),
            F.concat(F.lit("SG"), _text(key % 3)).alias("sell_group"),
            F.concat(F.lit("CM"), _text(key % 5)).alias("commodity_code"),
            F.lit("A").alias("product_status"),
            F.col("b.stock_type").alias("stock_type"),
            onhand.alias("onhand_qty"),
            F.col("b.committed").alias("committed_qty"),
            (unit * onhand).cast(MONEY).alias("ext_cost"),
            (unit * onhand).cast(MONEY).alias("ext_cogs"),
            (onhand * 2).cast(MONEY).alias("ext_weight"),
            F.col("b.demand").alias("pil"),
            F.col("b.demand").cast(MONEY).alias("demand_per_month"),
            (F.col("b.demand") * 12).cast("int").alias("sales_365_days"),
            F.col("b.demand").alias("hits_365_days"),
            F.lit("A").alias("rank_1"),
            F.lit("B").alias("rank_2"),
            F.lit(None).cast("string").alias("rank_3"),
            F.lit(None).cast("string").alias("rank_4"),
            F.lit(None).cast("string").alias("rank_5"),
            F.lit("invendata.txt").alias("_source_file"),
            (key * 20 + region * 4 + F.col("b.no")).cast("bigint").alias("_source_line"),
            self._loaded().alias("_loaded_at"),
        )

    @cached_property
    def stg_purchases(self) -> DataFrame:
        ship = F.col("l_shipdate").cast("date")
        cost = (F.col("l_extendedprice").cast(MONEY) * F.lit("0.75").cast("decimal(3,2)")).cast(MONEY)
        file_name = F.concat(F.lit("purch_"), _text(F.year(ship)), F.lit(".txt"))
        line_no = (F.col("l_orderkey") % 10000000 * 10 + F.col("l_linenumber")).cast("int")
        return self._lineitem.select(
            F.concat(file_name, F.lit(":"), _text(line_no)).alias("purchase_line_id"),
            self._company().alias("company_id"),
            F.concat(F.lit("PO"), _text("l_orderkey")).alias("po_no"),
            F.concat(F.lit("P"), _text("l_orderkey")).alias("order_id"),
            F.concat(F.lit("V"), _text("l_suppkey")).alias("vendor_id"),
            F.concat(F.lit("V"), _text("l_suppkey")).alias("pay_to_vendor_id"),
            _text("l_partkey").alias("product_id"),
            F.concat(F.lit("item "), _text("l_partkey")).alias("product_desc"),
            F.lit("A").alias("product_status"),
            F.concat(F.lit("BG"), _text(F.col("l_partkey") % 6)).alias("buy_group"),
            F.concat(F.lit("BY"), _text(F.col("l_suppkey") % 4)).alias("buyer_id"),
            F.concat(F.lit("W"), _text(F.col("l_suppkey") % 4)).alias("writer_id"),
            _text(F.col("l_suppkey") % 5).alias("order_branch_id"),
            _text(F.col("l_suppkey") % 5).alias("receive_branch_id"),
            F.lit("TRUCK").alias("ship_via"),
            # the column exists only in the files of the later years
            F.when(F.year(ship) >= 2000, F.col("l_linestatus")).alias("order_status"),
            F.date_sub(ship, 20).alias("order_date"),
            F.date_sub(ship, 5).alias("required_date"),
            F.date_sub(ship, 3).alias("received_date"),
            F.col("l_quantity").cast("int").alias("quantity"),
            cost.alias("ext_purchase_cost"),
            (F.col("l_quantity").cast("int") * 3).cast(MONEY).alias("ext_weight"),
            file_name.alias("_source_file"),
            line_no.alias("_source_line"),
            self._loaded().alias("_loaded_at"),
        )

    # ---- seeds ------------------------------------------------------------------------------

    @cached_property
    def seed_buyline_map(self) -> DataFrame:
        rows = [
            ("Brand#2", "Brand#1", "high", "identical description"),
            ("Brand#4", "Brand#3", "likely", "similar code, not applied"),
        ]
        return self.spark.createDataFrame(rows, "buy_line string, mapped_buy_line string, confidence string, note string")

    @cached_property
    def seed_customer_groups(self) -> DataFrame:
        key = F.col("c_custkey")
        return self._table("customer").filter(key % 20 == 19).select(
            _text("c_custkey").alias("customer_id"),
            _text(key - 1).alias("group_customer_id"),
            F.lit("same business, second account").alias("reason"),
        )

    @cached_property
    def seed_system_accounts(self) -> DataFrame:
        rows = [("HSE", "house account"), ("SP7", "shared login")]
        return self.spark.createDataFrame(rows, "salesperson_id string, reason string")
