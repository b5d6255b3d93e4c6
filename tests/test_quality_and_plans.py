from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

import compare
from regain.config import Settings
from regain.operators import opportunity, quality, windows
from regain.plans import catalog, checks, pipeline
from regain.plans.pipeline import DAYS, LINES, SCORES, Pipeline
from regain.plans.store import write_table
from regain.sources.sample import SampleTables

SMALL = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_checks_of_keys_are_made_one_at_a_time(spark):
    """One plan of all checks held the keys of all tables before."""
    t = {"a": spark.createDataFrame([("1",), ("1",)], "k string"), "b": spark.createDataFrame([("2",)], "k string")}
    kept = []

    def keep(df):
        kept.append(df.collect())
        return df

    assert quality.unique(t, [("a", "k"), ("b", "k")], keep).count() == 2
    assert quality.relationships(t, [("a", "k", "b", "k", "warn")], keep).count() == 1
    assert [[r.failing_rows for r in rows] for rows in kept] == [[1], [0], [2]]


def test_checks_report_failures(spark):
    t = {
        "child": spark.createDataFrame([("1", "a"), ("1", "b"), (None, "z")], "k string, v string"),
        "parent": spark.createDataFrame([("2",)], "k string"),
    }
    assert quality.unique(t, [("child", "k")]).first().failing_rows == 1
    assert [r.failing_rows for r in quality.not_null(t, {"child": ("k", "v")}).orderBy("column").collect()] == [1, 0]
    got = quality.accepted_values(t, [("child", "v", ("a", "b"))]).first()
    assert (got.failing_rows, got.sample_key) == (1, "z")
    got = quality.relationships(t, [("child", "k", "parent", "k", "warn")]).first()
    assert (got.failing_rows, got.sample_key, got.severity) == (2, "1", "warn")
    p = spark.createDataFrame([("s", "x"), ("s", "y"), ("t", "x")], "product_id string, product_desc string")
    for name in set(quality.SAME_ACROSS_BRANCHES) - {"product_desc"}:
        p = p.withColumn(name, F.lit(None).cast("string"))
    assert [r.product_id for r in quality.same_across_branches(p.withColumn("is_kit", F.lit(False))).collect()] == ["s"]


def test_declared_checks():
    assert len(checks.UNIQUE) == 29 and len(checks.ACCEPTED_VALUES) == 15 and len(checks.RELATIONSHIPS) == 23


def test_date_filters_reach_the_scan(spark, tmp_path):
    p = Pipeline.for_query(spark, SampleTables(spark, SMALL))
    written = write_table(p.line_transactions, str(tmp_path / "tx"))
    plan = plan_of(windows.product_changes(written, p.products, p.dates))
    assert "GreaterThan(ship_date" in plan
    scan = [line for line in plan.splitlines() if "tx]" in line or "/tx" in line][0]
    assert "company_id" not in scan.split("ReadSchema")[1]


def test_no_python_and_no_cartesian_product(spark):
    p = Pipeline.for_query(spark, SampleTables(spark, SMALL))
    for df in (p.lines, p.transactions, p.days, p.product_changes, p.sales_detail, p.product_mart):
        plan = plan_of(df)
        assert "Python" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan_of(p.transactions)


def test_daily_aggregate_hashes_and_combines_before_the_shuffle(spark):
    plan = plan_of(Pipeline.for_query(spark, SampleTables(spark, SMALL)).product_changes)
    top = plan[: plan.index("Scan parquet") if "Scan parquet" in plan else None]
    assert "partial_max" in plan and "SortAggregate(key=[customer_id" not in top


def test_row_order_and_partitions_do_not_matter(spark):
    t = SampleTables(spark, SMALL)
    a = Pipeline.for_query(spark, t)
    shuffled = windows.customer_days(a.transactions.repartition(13).sortWithinPartitions(F.rand(3)))
    key = ["customer_id", "ship_date"]
    assert a.days.orderBy(*key).collect() == shuffled.orderBy(*key).collect()


QUICK = (
    "decode_mixed", "clean_text", "stage_orders", "stage_customers", "classify_lines", "reconcile_invoices", "classify_headers",
    "customer_transactions", "map_buylines", "resolve_salespeople", "collapse_products", "inventory_by_branch", "customer_12m_change",
    "product_changes", "brand_changes", "product_mart", "customer_years", "opportunities", "call_sheet", "cost_basis_check",
)


@pytest.fixture(scope="module")
def con():
    return compare.duck(SMALL)


@pytest.mark.parametrize("name", QUICK)
def test_against_sql(spark, con, name):
    from oracle.queries import ORACLE

    assert compare.compare(catalog.QUERIES[name](spark, SMALL), con, ORACLE[name]) == "ok"


def test_every_query_has_sql():
    from oracle.queries import ORACLE

    assert set(catalog.QUERIES) == set(ORACLE)


def test_whole_lines_are_exchanged_twice_for_sales_detail(spark, keep):
    """Once for each lookup before: products, invoices, bill-to and ship-to accounts."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    kept = []
    try:
        p = Pipeline.for_query(spark, SampleTables(spark, SMALL))
        p.lines = keep(p.lines)
        p._keep = lambda df: kept.append(plan_of(df)) or keep(df)
        last = plan_of(p.sales_detail.select("sales_line_id", "_source_file", "customer_name", "bill_to_customer_name", "ship_to_customer_name"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    (first,) = kept
    assert first.count("hashpartitioning(product_id") == 3  # the lines, and the products twice: first branch, lookup
    assert "hashpartitioning(invoice_no" not in first and "hashpartitioning(bill_to" not in first
    assert last.count("hashpartitioning(bill_to_customer_id") <= 3 and "hashpartitioning(ship_to_customer_id" in last
    wide = [line for line in last.splitlines() if "Exchange hashpartitioning(coalesce(invoice_no" in line]
    assert len(wide) == 1


def test_lines_meet_the_few_remapped_accounts_without_an_exchange(spark):
    """The size of an aggregated list is not known beforehand: the lines were exchanged to join it."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2k")
    try:
        for shared in (LINES, SCORES, DAYS):
            p = Pipeline.for_query(spark, SampleTables(spark, SMALL), shared=shared)
            assert "Exchange hashpartitioning(bill_to_customer_id" not in plan_of(p.line_transactions)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_customers_days_lie_in_one_file(spark):
    """They lay in all files, so aggregates per customer exchanged about as many rows as there are days."""
    days = Pipeline.for_query(spark, SampleTables(spark, SMALL), shared=SCORES).days
    files = days.select("customer_id", F.input_file_name().alias("file")).distinct()
    assert files.groupBy("customer_id").count().filter("count > 1").isEmpty()
    plain = Pipeline.for_query(spark, SampleTables(spark, SMALL), shared=DAYS).days
    assert days.exceptAll(plain).isEmpty() and plain.exceptAll(days).isEmpty()


def test_scoring_aggregates_per_customer_without_an_exchange(spark):
    """The lines were exchanged for the days, again to lay those together, for the invoices and for the products."""
    p = Pipeline.for_query(spark, SampleTables(spark, SMALL), shared=SCORES)
    changes = plan_of(p.product_changes)
    assert "Exchange" not in plan_of(windows.customer_days(p.transactions)) + plan_of(p.purchase_invoices)
    assert "Exchange hashpartitioning(customer_id" not in changes and "Exchange hashpartitioning(_groupingexpression" not in changes


def test_a_customer_with_most_rows_is_not_put_in_a_bucket(spark, monkeypatch):
    even = Pipeline.for_query(spark, SampleTables(spark, SMALL), shared=SCORES)
    a, bucketed = even.scores, plan_of(even.purchase_invoices)
    monkeypatch.setattr(pipeline, "MOST_UNEVEN", 0.0)
    uneven = Pipeline.for_query(spark, SampleTables(spark, SMALL), shared=SCORES)
    b = uneven.scores
    assert "Bucketed: true" in bucketed and "Exchange" in plan_of(windows.customer_days(uneven.transactions))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count() > 50


def test_invoice_sums_are_exchanged_once_for_headers_and_lines(spark, keep):
    """Orders joined to the sums of their lines were exchanged again, to meet the same sums by the number as text."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = Pipeline.for_query(spark, SampleTables(spark, SMALL, keep=keep))
        frame = p.invoices.select("invoice_no", "reconciliation_status", "line_price_total", "line_cogs_total", "header_cogs_total")
        frame.collect()
        plan = plan_of(frame).split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "l_orderkey" not in "".join(line for line in plan.splitlines() if " Exchange" in line)
    assert len([line for line in plan.splitlines() if " Exchange" in line]) <= 3


def test_brands_are_read_once_for_those_that_stopped(spark):
    """Names and totals each summed up the products by brand."""
    rows = [("a", f"B{i}", f"Line {i}" if i != 4 else None, D(100 * (i % 5) + 300), i != 2) for i in range(7)] + [("b", "B1", "Line 1", D(300), True)]
    brands = spark.createDataFrame(rows, "customer_id string, brand string, brand_desc string, gp_prior_12m decimal(28,4), is_mostly_stopped boolean")
    got = opportunity.stopped_brands(brands, Settings(top_brands_in_reason=3))
    assert plan_of(got).count("Scan ExistingRDD") == 1
    assert {r.customer_id: (r.stopped_brand_count, r.stopped_brands_gp_prior_12m, r.stopped_brands) for r in got.collect()} == {
        "a": (6, D(2700), "B4, Line 3, Line 1"), "b": (1, D(300), "Line 1")
    }


def test_days_are_aggregated_once_for_many_dates(spark):
    """The lines were read and exchanged again for each part of the plan that reads the days."""
    assert "hashpartitioning(l_orderkey" not in plan_of(catalog.QUERIES["early_drop_by_month"](spark, SMALL))


def test_detail_query_holds_no_exchange_of_all_lines(spark, con):
    """The plan of the whole table held every exchange of its lines until it ended."""
    from oracle.queries import ORACLE

    detail = catalog.QUERIES["sales_detail"](spark, SMALL)
    assert "Exchange" not in plan_of(detail) and "Join" not in plan_of(detail)
    assert compare.compare(detail, con, ORACLE["sales_detail"]) == "ok"


def test_products_are_exchanged_before_they_are_sorted(spark):
    """Each task sorted all the rows of its split before."""
    t = SampleTables(spark, SMALL)
    for df in (Pipeline.for_query(spark, t).products, quality.same_across_branches(t.stg_products)):
        plan = plan_of(df)
        below = plan[plan.index("Exchange hashpartitioning(product_id"):].split("BroadcastExchange IdentityBroadcastMode")[0]
        assert "Sort" not in below and "Aggregate" not in below and "WindowGroupLimit" not in below


def test_lines_are_joined_to_their_orders_once(spark, keep):
    """A query that reads the lines for themselves and for their invoices joined them again each time."""
    written = []
    plain, kept = SampleTables(spark, SMALL), SampleTables(spark, SMALL, keep=lambda df: written.append(1) or keep(df))
    for name in ("stg_sales_core", "stg_orders", "stg_sales"):
        a, b = getattr(plain, name), getattr(kept, name)
        assert a.schema.simpleString() == b.schema.simpleString()
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert len(written) == 1
    assert "Join" not in plan_of(kept.stg_sales_core)


def test_repeats_are_found_a_step_at_a_time(spark, con):
    """One plan held the exchanges of all lines for all three steps until it ended."""
    from oracle.queries import ORACLE

    proof = catalog.QUERIES["duplicate_line_proof"](spark, SMALL)
    plan = plan_of(proof)
    assert "p_partkey" not in plan and "o_custkey" not in plan  # what is left: the few invoices meet their headers
    assert compare.compare(proof, con, ORACLE["duplicate_line_proof"]) == "ok"


def test_detail_lookups_are_written_once(spark, monkeypatch):
    """Each year worked out products, salespeople and groups again, and exchanged its lines to meet the salespeople."""
    from regain.plans import versions

    made, put = [], versions.put

    def watched(df, path, *args, part=None, **more):
        if path.endswith("mart_sales_detail"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
            made.extend([plan_of(part(F.year("ship_date") == year)) for year in (1995, 1996)])
        return put(df, path, *args, part=part, **more)

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(versions, "put", watched)
    try:
        catalog.QUERIES["sales_detail"](spark, SMALL)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(made) == 2
    for plan in made:
        assert "Aggregate" not in plan and "Window" not in plan and "hashpartitioning(outside_salesperson_id" not in plan
        assert "ShuffledHashJoin [invoice_no" in plan  # the lines lie in buckets of invoices
