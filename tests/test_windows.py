import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from regain.config import Settings
from regain.operators import marts, opportunity, windows
from regain.operators.ranking import rank_desc, row_numbers

DATES = windows.ReportingDates(dt.date(2024, 2, 29), dt.date(2023, 2, 28), dt.date(2022, 2, 28))


def test_reporting_dates_clamp_month_end(spark):
    got = windows.reporting_dates(spark.createDataFrame([(dt.date(2024, 2, 29),), (dt.date(2020, 1, 1),)], "ship_date date"))
    assert windows.ReportingDates.read(got) == DATES
    empty = windows.reporting_dates(spark.createDataFrame([], "ship_date date"))
    assert windows.ReportingDates.read(empty).as_of is None


def tx(spark, rows):
    """rows: customer, invoice, date, price, profit, quantity"""
    df = spark.createDataFrame(
        [(c, i, "p", d, D(p), D(g), q) for c, i, d, p, g, q in rows],
        "customer_id string, invoice_no string, product_id string, ship_date date, ext_price decimal(18,4), gross_profit decimal(18,4), quantity int",
    )
    return (
        df.withColumn("is_financial", F.col("ext_price") != 0).withColumn("is_purchase", F.col("ext_price") > 0)
        .withColumn("is_return_credit", F.col("ext_price") < 0).withColumn("is_consignment", F.lit(False))
    )


def test_windows_open_at_the_start_closed_at_the_end(spark):
    rows = [("a", "1", dt.date(2022, 2, 28), 1, 1, 1), ("a", "2", dt.date(2022, 3, 1), 2, 2, 1), ("a", "3", dt.date(2023, 2, 28), 4, 4, 1),
            ("a", "4", dt.date(2023, 3, 1), 8, 8, 1), ("a", "5", dt.date(2024, 2, 29), 16, 16, 1)]
    got = marts.customer_12m_change(windows.customer_days(tx(spark, rows)), DATES).first()
    assert (got.sales_prior_12m, got.sales_last_12m) == (D(6), D(24))
    assert got.sales_change_12m_pct == 3.0


def test_years_are_dense_and_same_period_uses_month_and_day(spark):
    rows = [("a", "1", dt.date(2022, 2, 28), 1, 1, 1), ("a", "1", dt.date(2022, 3, 1), 2, 2, 1), ("b", "2", dt.date(2024, 2, 29), 4, 4, 1),
            ("n", "3", dt.date(2021, 5, 1), -1, -1, 1)]
    t = tx(spark, rows)
    got = {(r.customer_id, r.sales_year): r for r in windows.customer_years(windows.customer_days(t), windows.purchase_invoices(t), DATES).collect()}
    assert set(got) == {(c, y) for c in "ab" for y in (2021, 2022, 2024)}
    assert (got["a", 2022].full_year_sales, got["a", 2022].same_period_sales, got["a", 2022].full_year_purchase_invoices) == (D(3), D(1), 1)
    assert got["b", 2024].is_partial_year and got["b", 2024].same_period_label == "Jan 1 - Feb 29" and got["b", 2021].full_year_sales == 0


def test_last_price_is_of_the_latest_purchase(spark):
    rows = [("a", "1", dt.date(2023, 5, 1), 100, 300, 3), ("a", "2", dt.date(2023, 6, 1), 50, 1, 4), ("a", "3", dt.date(2023, 6, 1), 49, 1, 1),
            ("a", "4", dt.date(2023, 7, 1), -9, 1, 2), ("a", "5", dt.date(2023, 8, 1), 70, 1, -1)]
    products = spark.createDataFrame([("p", "B", "Brand")], "product_id string, mapped_buy_line string, buy_line_desc string")
    got = windows.product_changes(tx(spark, rows), products, DATES).first()
    assert got.last_unit_price == 12.5 and got.last_purchase_date == dt.date(2023, 8, 1)


@pytest.mark.parametrize("prior, last, stopped", [("250", "50", True), ("250", "50.01", False), ("249.99", "0", False)])
def test_mostly_stopped(spark, prior, last, stopped):
    rows = [("a", "1", dt.date(2022, 5, 1), 1, prior, 1), ("a", "2", dt.date(2023, 5, 1), 1, last, 1)]
    products = spark.createDataFrame([("p", "B", "Brand")], "product_id string, mapped_buy_line string, buy_line_desc string")
    assert windows.product_changes(tx(spark, rows), products, DATES).first().is_mostly_stopped is stopped


def test_distributed_ranks_equal_plain_windows(spark, keep):
    rng = random.Random(7)
    rows = [(f"g{rng.choice([0, 0, 0, 1, 2])}", rng.randrange(400), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, score int, id int").repartition(6)
    plain = df.withColumn("rank", F.rank().over(Window.orderBy(F.col("score").desc())))
    plain = plain.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("score", "id")))
    ranked = rank_desc(df, "score", "rank", keep)
    numbered = row_numbers(ranked, ["g"], [F.col("score"), F.col("id")], "n", keep)
    columns = ["g", "score", "id", "rank", "n"]
    assert sorted(map(tuple, numbered.select(*columns).collect())) == sorted(map(tuple, plain.select(*columns).collect()))


SIGNAL_SCHEMA = (
    "purchase_status string, gp_year_2 decimal(18,4), gp_year_3 decimal(18,4), is_behind_this_year boolean, is_gone_quiet boolean, is_declining boolean"
)


@pytest.mark.parametrize("row, kind", [
    (("lapsed", D(999), None, False, True, True), "former_customer"), (("lapsed", D(1000), None, False, True, False), "declining"),
    (("active_last_12m", D(0), D(0), True, False, False), "early_warning"), (("active_last_12m", D(0), D(0), False, True, True), "declining"),
    (("active_last_12m", D(0), D(0), False, False, True), "recovering"), (("active_last_12m", D(0), D(0), False, False, False), None),
])
def test_opportunity_types(spark, row, kind):
    assert opportunity.with_type(spark.createDataFrame([row], SIGNAL_SCHEMA)).first().opportunity_type == kind


@pytest.mark.parametrize("row, factor", [
    (("lapsed", True, 1.0, 400), "0.5"), (("active_last_12m", True, 2.0, 5), "1.0"), (("active_last_12m", True, 4.0, 5), "0.8"),
    (("active_last_12m", True, 4.01, 5), "0.5"), (("active_last_12m", False, None, 90), "1.0"), (("active_last_12m", False, None, 365), "0.8"),
    (("active_last_12m", False, None, 366), "0.5"),
])
def test_recoverability(spark, row, factor):
    df = spark.createDataFrame([row], "purchase_status string, has_rhythm boolean, gap_ratio double, days_since_last_purchase int")
    assert opportunity.with_recoverability(df).first().recoverability_factor == D(factor)


def signals(spark, y1, y2, y3, was, now, invoices=5, gap=10.0, days=10):
    customer = spark.createDataFrame(
        [("a", "A", None, None, False, None, "active_last_12m", dt.date(2024, 1, 1), days, gap, invoices, D(0), D(0))],
        "customer_id string, customer_name string, salesperson_id string, salesperson_name string, is_house_account boolean, home_branch_name string, "
        "purchase_status string, last_purchase_date date, days_since_last_purchase int, avg_days_between_purchases double, purchase_invoice_count bigint, "
        "gross_profit_last_12m decimal(18,4), gross_profit_prior_12m decimal(18,4)",
    )
    years = [("a", 2024 - back, D(full), D(same)) for back, full, same in ((3, y1, 0), (2, y2, 0), (1, y3, was), (0, 0, now)) if full is not None]
    frame = spark.createDataFrame(years, "customer_id string, sales_year int, full_year_gross_profit decimal(18,4), same_period_gross_profit decimal(18,4)")
    none = spark.createDataFrame([], "customer_id string, stopped_brand_count bigint, stopped_brands_gp_prior_12m decimal(18,4), stopped_brands string")
    return opportunity.scored(opportunity.signals(customer, frame, none, DATES, Settings()), Settings()).first()


def test_signal_thresholds(spark):
    two = signals(spark, 9000, 8000, 7500, 0, 0)
    assert two.is_two_year_decline and two.lost_gp_declining == 1500
    spike = signals(spark, 16000, 150000, 28000, 0, 0)
    assert not spike.is_declining
    sharp = signals(spark, 5000, 6000, 3750, 0, 0)
    assert sharp.is_sharp_drop and sharp.lost_gp_declining == 1250
    assert not signals(spark, 3990, 5000, 2992, 0, 0).is_sharp_drop
    assert signals(spark, 0, 0, 0, 10000, 9000).is_behind_this_year and not signals(spark, 0, 0, 0, 10000, 9001).is_behind_this_year
    assert not signals(spark, 0, 0, 0, 9990, 8991).is_behind_this_year
    short = signals(spark, None, 5000, 100, 0, 0)  # a missing year is left out of the comparison
    assert not short.is_two_year_decline and short.is_sharp_drop
    assert signals(spark, 0, 0, 0, 0, 0, days=41).is_gone_quiet and not signals(spark, 0, 0, 0, 0, 0, days=40).is_gone_quiet
    assert not signals(spark, 0, 0, 0, 0, 0, invoices=4, days=90).has_rhythm
