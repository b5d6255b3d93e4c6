import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from regain import config as c
from regain.operators import dimensions, rules, staging

LINE_SCHEMA = "sales_line_id string, customer_po string, product_desc string, ext_price decimal(18,4), ext_cogs decimal(18,4)"
OTHER = (
    "company_id invoice_no order_id bill_to_customer_id ship_to_customer_id product_id product_status sell_group outside_salesperson_id "
    "inside_salesperson_id writer_id price_branch_id ship_branch_id ship_via sales_source price_contract_id cost_contract_id _source_file"
).split()


def lines(spark, rows):
    df = spark.createDataFrame([(str(i), po, desc, D(p), D(g)) for i, (po, desc, p, g) in enumerate(rows)], LINE_SCHEMA)
    for name in OTHER:
        df = df.withColumn(name, F.lit("x"))
    for name in ("ship_date", "order_date", "required_date"):
        df = df.withColumn(name, F.lit(dt.date(2026, 1, 2)))
    for name in ("is_direct_ship", "is_price_override", "is_cogs_override", "is_cost_override", "is_manual_override"):
        df = df.withColumn(name, F.lit(False))
    return df.withColumn("quantity", F.lit(1)).withColumn("ext_cost", F.lit(D(0))).withColumn("ext_weight", F.lit(D(0))).withColumn("_source_line", F.lit(1))


def test_line_types(spark):
    cases = [
        (("CON T 4/21", "pipe", 0, 0), "consignment_transfer"), (("ACH", "ONLINE PAYMENT", 0, 0), "payment_record"),
        (("STOCK TRANSFER", "pipe", 0, 0), "stock_transfer"), ((None, "pipe", 0, 0), "other_zero_dollar"),
        (("CONSIGNMENT", "pipe", -5, -3), "return_credit"), (("JOB", "pipe", 0, 3), "no_charge"),
        (("CONSIGNMENT", "pipe", 5, 3), "consignment_billing"), (("CONSTRUCTION JOB", "pipe", 5, 3), "sale"),
    ]
    found = rules.classify_lines(lines(spark, [row for row, _ in cases])).orderBy(F.col("sales_line_id").cast("int")).collect()
    assert [r.line_type for r in found] == [kind for _, kind in cases]
    assert [r.is_financial for r in found] == [False] * 4 + [True] * 4
    assert [r.is_purchase for r in found] == [False] * 6 + [True] * 2
    assert [r.is_return_credit for r in found] == [False] * 4 + [True] + [False] * 3
    assert found[4].gross_profit == D("-2.0000")


HEADERS = [
    ("SERVICE CHG", "OUT", 10, "service_charge"), ("REBATE", "SR", 10, "service_charge"), ("FUEL SURCHARGE", "OUT", 10, "surcharge_fee"),
    ("COFFEE", "OUT", 10, "other_adjustment"), ("PRE-BUY", "OUT", 10, "prebuy_prepayment"), ("LOYALTY", "OUT", 10, "rebate_loyalty"),
    ("BAD DEBT", "OUT", 10, "bad_debt"), ("AR ADJ", "OUT", 10, "ar_adjustment"), ("ACH RETURN", "OUT", 10, "payment_correction"),
    (None, "OUT", 10, "other_adjustment"), ("REBATE", "OUT", 0, "other_zero_dollar"), ("DEPOSIT REBATE", "OUT", 10, "prebuy_prepayment"),
]


def orders(spark, rows):
    """rows: invoice_no, customer_po, source, total"""
    df = spark.createDataFrame([(n, po, s, D(t)) for n, po, s, t in rows], "invoice_no string, customer_po string, sales_source string, item_total decimal(18,4)")
    for name in "company_id bill_to_customer_id ship_to_customer_id outside_salesperson_id inside_salesperson_id price_branch_id ship_branch_id _source_file".split():
        df = df.withColumn(name, F.lit("x"))
    for name in "cogs_total sales_tax freight_billed_out handling_billed_out".split():
        df = df.withColumn(name, F.lit(0).cast("decimal(18,4)"))
    return df.withColumn("ship_date", F.lit(dt.date(2026, 1, 2))).withColumn("item_count", F.lit(1)).withColumn("_source_line", F.lit(1))


def test_header_types(spark):
    heads = orders(spark, [(str(i), po, s, t) for i, (po, s, t, _) in enumerate(HEADERS)])
    none = rules.money_flags(lines(spark, [])).limit(0)
    out = rules.classify_headers(rules.reconcile_invoices(heads, none)).orderBy(F.col("invoice_no").cast("int")).collect()
    assert [r.line_type for r in out] == [kind for *_, kind in HEADERS]
    for r in out:
        assert r.charge_amount + r.rebate_amount + r.adjustment_amount == (0 if r.line_type == c.ZERO_TYPE else 10)
        assert (r.charge_amount != 0) == (r.line_type in c.CHARGE_TYPES)


@pytest.mark.parametrize("header, status", [("10", "matched"), ("10.01", "matched"), ("9.99", "matched"), ("10.02", "variance")])
def test_reconciliation(spark, header, status):
    sold = rules.money_flags(lines(spark, [("J", "pipe", 4, 1), ("J", "pipe", 6, 1)])).withColumn("invoice_no", F.lit("7"))
    got = rules.reconcile_invoices(orders(spark, [("7", None, "OUT", header)]), sold).first()
    assert (got.reconciliation_status, got.line_count) == (status, 2)


def test_transactions_add_corrections_and_rebates(spark):
    sold = rules.money_flags(lines(spark, [("J", "pipe", 4, 1), ("J", "pipe", 6, 1)])).withColumn("invoice_no", F.lit("7"))
    heads = orders(spark, [("7", None, "OUT", 12), ("8", "REBATE", "OUT", -3), ("9", "SERVICE CHG", "OUT", 5)])
    invoices = rules.reconcile_invoices(heads, sold)
    remap = spark.createDataFrame([("x", "y")], "account_id string, customer_id string")
    tx = rules.customer_transactions(rules.line_transactions(sold, remap), rules.exception_transactions(invoices, remap)).collect()
    kinds = sorted((r.transaction_type, r.ext_price) for r in tx)
    assert kinds == [("invoice_correction", D(2)), ("product_line", D(4)), ("product_line", D(6)), ("rebate", D(-3))]
    assert {r.customer_id for r in tx} == {"y"} and {r.bill_to_customer_id for r in tx} == {"x"}
    fix = [r for r in tx if r.transaction_type == "invoice_correction"][0]
    ref = rules.invoice_corrections(invoices).first()
    assert (fix.transaction_id, fix.ext_price, fix.ext_cogs, fix.gross_profit) == (ref.transaction_id, ref.ext_price, ref.ext_cogs, ref.gross_profit)


def test_product_type_missing_or_unknown_is_no_product(spark):
    raw = spark.createDataFrame([("1", "PA"), ("2", "512"), ("3", None)], "Product_ID string, GL_Type string")
    needed = {*staging.PRODUCTS_TEXT.values(), "Prod_Commodity_Code", "Kit", "BUY_PACK", "TARGET", *staging.LINEAGE} - set(raw.columns)
    for name in needed:
        raw = raw.withColumn(name, F.lit(None).cast("timestamp" if name == "_loaded_at" else "string"))
    types = spark.createDataFrame([("PA",), (None,)], "gl_type string")
    assert [r.is_non_product for r in staging.stage_products(raw, types).orderBy("product_id").collect()] == [False, True, True]


def test_people_with_one_name(spark):
    lookup = spark.createDataFrame([("A", "Ann Lee"), ("B", "ANN LEE"), ("C", "Cy")], "salesperson_id string, salesperson_name string")
    sales = spark.createDataFrame([("B", "B"), ("A", None), ("Z", "B")], "outside_salesperson_id string, inside_salesperson_id string")
    customers = spark.createDataFrame([("C",), (None,)], "salesperson_id string")
    system = spark.createDataFrame([("C",)], "salesperson_id string")
    got = {r.salesperson_id: r for r in dimensions.resolve_salespeople(lookup, sales, customers, system).collect()}
    assert got["A"].person_id == "B" and got["A"].person_name == "ANN LEE" and got["B"].usage_count == 3
    assert got["Z"].is_in_lookup is False and got["Z"].person_id == "Z" and got["Z"].person_name is None
    assert got["C"].is_system_account and not got["A"].is_system_account


def test_buylines_apply_only_sure_pairs(spark):
    lookup = spark.createDataFrame([("A", "Alpha"), ("B", "Beta"), ("C", "Gamma")], "buy_line string, buy_line_desc string")
    products = spark.createDataFrame([("A",), ("X",), ("X",), (None,)], "buy_line string")
    seed = spark.createDataFrame([("B", "A", "high", ""), ("C", "A", "likely", "")], "buy_line string, mapped_buy_line string, confidence string, note string")
    got = {r.buy_line: (r.mapped_buy_line, r.buy_line_desc, r.is_in_lookup) for r in dimensions.map_buylines(lookup, products, seed).collect()}
    assert got == {"A": ("A", "Alpha", True), "B": ("A", "Beta", True), "C": ("C", "Gamma", True), "X": ("X", "X", False)}


def test_another_companys_words(spark):
    """Patterns and marker trimming are settings of a run."""
    from regain.config import Settings
    from regain.functions.text import is_present

    cfg = Settings(consign_word=r"\bKOMMISSION", consign_abbreviation=r"\bKOM\b", stock_move="UMLAGERUNG", header_patterns=(("GUTSCHRIFT", "rebate_loyalty"),))
    cases = [("KOMMISSION", "pipe", 0, 0), ("UMLAGERUNG", "pipe", 0, 0), ("CONSIGN", "pipe", 0, 0)]
    out = rules.classify_lines(lines(spark, cases), cfg).orderBy(F.col("sales_line_id").cast("int")).collect()
    assert [r.line_type for r in out] == ["consignment_transfer", "stock_transfer", "other_zero_dollar"]
    df = spark.createDataFrame([("Gutschrift", "OUT", 5), ("REBATE", "OUT", 5)], "customer_po string, sales_source string, header_item_total int")
    assert [r[0] for r in df.select(rules.header_line_type(cfg)).collect()] == ["rebate_loyalty", "other_adjustment"]
    marks = spark.createDataFrame([("*",), (" ",), (None,)], "m string")
    assert [tuple(r) for r in marks.select(is_present("m"), is_present("m", True)).collect()] == [(True, True), (True, False), (False, False)]
