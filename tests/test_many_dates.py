import calendar
import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from regain.operators import analyses, closure, cube, distinct, explore, history, marts, windows
from regain.plans.pipeline import Pipeline
from regain.sources.sample import SampleTables
from regain.sources.untidy import linked_customers

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def p(spark, tmp_path_factory):
    """The pipeline of the small sample with its lines and days written down."""
    root = tmp_path_factory.mktemp("many")

    def table(name, df):
        if name not in ("money_lines", "customer_days", "purchase_invoices"):
            return df
        df.write.parquet(f"file://{root}/{name}")
        return spark.read.parquet(f"file://{root}/{name}")

    return Pipeline(SampleTables(spark, SMALL), table=table)


def dates_at(day: dt.date) -> windows.ReportingDates:
    def back(years):
        year = day.year - years
        return dt.date(year, day.month, min(day.day, calendar.monthrange(year, day.month)[1]))

    return windows.ReportingDates(day, back(1), back(2))


def test_month_ends_equal_a_rebuild_per_date(spark, p):
    every = history.month_end_change(p.days, p.dates.as_of)
    names = ["sales_last_12m", "sales_prior_12m", "gross_profit_last_12m", "gross_profit_prior_12m"]
    for day in (dt.date(1998, 2, 28), dt.date(2000, 2, 29), dt.date(2000, 7, 31)):
        dates = dates_at(day)
        seen = p.days.filter((F.col("ship_date") <= F.lit(day)) & dates.in_either())
        want = marts.customer_12m_change(seen, dates).select("customer_id", *names).collect()
        got = every.filter(F.col("month_end") == F.lit(day)).select("customer_id", *names).collect()
        assert len(want) > 30 and sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_look_ups_read_no_line(spark, p):
    plan = history.month_end_change(p.days, p.dates.as_of)._jdf.queryExecution().executedPlan().toString()
    assert "money_lines" not in plan and "Join" not in plan


def test_early_drops_by_month_equal_the_yearly_analysis_on_that_day(spark, p):
    every = history.early_drop_by_month(p.days, p.dates.as_of, min_profit=500)
    year = p.dates.as_of.year
    some = 0
    for month in (3, 6, 11):
        dates = dates_at(dt.date(year, month, calendar.monthrange(year, month)[1]))
        years = windows.customer_years(p.days, p.purchase_invoices, dates)
        want = analyses.early_drop_predicts(years, dates, 500).select("band", "cases", "ended_down", "ended_down_10").collect()
        got = every.filter(F.col("month_no") == month).drop("month_no").collect()
        some += len(want)
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert some > 6


def test_as_of_look_ups(spark):
    days = spark.createDataFrame([("a", dt.date(2024, 1, 5), 1, 10), ("a", dt.date(2024, 3, 1), 2, None)], "customer_id string, ship_date date, sales int, profit int")
    asked = spark.createDataFrame([("a", dt.date(2024, 1, d), d) for d in (4, 5, 6)] + [("a", dt.date(2025, 1, 1), 0), ("b", dt.date(2024, 1, 9), 9)], "customer_id string, day date, tag int")
    got = history.looked_up(history.cumulative(days), asked).collect()
    assert sorted((r["tag"], r["days"], r["sales"], r["profit"]) for r in got) == [(0, 2, 3, 10), (4, 0, 0, 0), (5, 1, 1, 10), (6, 1, 1, 10), (9, 0, 0, 0)]


def test_bitmaps_equal_distinct_counts_and_merge(spark, p, keep):
    bought = p.money_lines.filter("is_purchase")
    numbers = keep(distinct.dense_numbers(bought, "bill_to_customer_id", keep))
    n = numbers.count()
    assert sorted(r["member_no"] for r in numbers.collect()) == list(range(1, n + 1))
    whole = keep(distinct.monthly_bitmaps(bought, "product_id", "bill_to_customer_id", numbers))
    months = distinct.rolling_distinct(whole, "product_id", "buyers")
    # members far apart lie in different buckets; a bucket counts in months it has nothing new in
    far = numbers.withColumn("member_no", F.col("member_no") * 20_011)
    wide = keep(distinct.monthly_bitmaps(bought, "product_id", "bill_to_customer_id", far))
    assert wide.select("bucket").distinct().count() > 10
    assert sorted(map(tuple, distinct.rolling_distinct(wide, "product_id", "buyers").collect())) == sorted(map(tuple, months.collect()))
    # loads in three parts, one of them twice
    parts = [keep(distinct.monthly_bitmaps(bought.filter(F.pmod(F.xxhash64("sales_line_id"), F.lit(3)) == k), "product_id", "bill_to_customer_id", numbers)) for k in (2, 0, 1, 0)]
    again = distinct.merged(parts, "product_id")
    assert sorted((r["product_id"], r["month"], r["bucket"], bytes(r["members"])) for r in again.collect()) == sorted(
        (r["product_id"], r["month"], r["bucket"], bytes(r["members"])) for r in whole.collect()
    )
    # the product mart's two-level count, for a window of whole months
    day = dt.date(2000, 6, 30)
    dates = dates_at(day)
    mart = marts.product_mart(p.money_lines.filter(F.col("ship_date") <= F.lit(day)), p.products, p.stock, dates)
    want = {r["product_id"]: r["customers_last_12m"] for r in mart.filter("customers_last_12m > 0").collect()}
    upto = whole.filter((F.col("month") <= F.lit(dt.date(2000, 6, 1))) & (F.col("month") > F.lit(dt.date(1999, 6, 1))))
    got = upto.groupBy("product_id", "bucket").agg(F.bitmap_or_agg("members").alias("m")).groupBy("product_id").agg(F.sum(F.bitmap_count("m")).alias("n"))
    assert {r["product_id"]: r["n"] for r in got.collect()} == want and len(want) > 20
    assert "money_lines" not in months._jdf.queryExecution().executedPlan().toString()


def test_bitmaps_grow_with_what_they_hold(spark, keep):
    """4 KB for each owner, month and bucket before, and a row for each bucket in each month of its owner."""
    rows = spark.range(6000).select(
        F.lit("a").alias("owner"), F.concat(F.lit("m"), F.col("id") * 7 % 1501).alias("member"),
        F.expr("date_add(date'2020-01-15', cast(id % 1200 as int))").alias("ship_date"),
    )
    numbers = keep(distinct.dense_numbers(rows, "member", keep))
    state = keep(distinct.monthly_bitmaps(rows, "owner", "member", numbers))
    assert state.agg(F.max(F.length("members")), F.sum(F.bitmap_count("members"))).first() == (
        8, rows.select("member", F.trunc("ship_date", "month")).distinct().count()
    )
    met = {}
    for r in rows.collect():
        met.setdefault(r["ship_date"].year * 12 + r["ship_date"].month, set()).add(r["member"])
    want = {m: len(set().union(*[met.get(k, set()) for k in range(m - 11, m + 1)])) for m in met}
    got = distinct.rolling_distinct(state, "owner", "n")
    assert {r["month"].year * 12 + r["month"].month: r["n"] for r in got.collect()} == want and len(want) == 40
    # months without any: what left the window in them is gone
    far = state.filter("month in (date'2020-02-01', date'2020-03-01', date'2021-03-01')")
    assert [r["n"] for r in distinct.rolling_distinct(far, "owner", "n").orderBy("month").collect()] == [
        len(met[24242]), len(met[24242] | met[24243]), len(met[24255])
    ]


def test_rhythm_states_merge_in_any_order(spark, p, keep):
    whole = history.rhythm_of_states(history.rhythm_states(p.days))
    want = sorted(map(tuple, whole.collect()))
    plain = marts.buying_rhythm(p.days, p.purchase_invoices, p.dates).filter("purchase_day_count > 0")
    assert {r[0]: (r["purchase_day_count"], r["avg_days_between_purchases"]) for r in plain.collect()} == {
        r["customer_id"]: (r["purchase_day_count"], r["avg_days_between_purchases"]) for r in whole.collect()
    }
    load = F.pmod(F.xxhash64("ship_date", "customer_id"), F.lit(5))
    parts = [keep(history.rhythm_states(p.days.filter(load == k))) for k in range(5)]
    for order in ((0, 1, 2, 3, 4), (4, 2, 0, 1, 3, 2, 2)):
        merged = history.merged_states([parts[k] for k in order])
        assert sorted(map(tuple, history.rhythm_of_states(merged).collect())) == want
    # states of states
    left, right = (history.merged_states([parts[k] for k in ks]) for ks in ((3, 1), (0, 4, 2)))
    assert sorted(map(tuple, history.rhythm_of_states(history.merged_states([right, left])).collect())) == want


def brute_groups(links):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return sorted((x, root(x)) for x in list(parent))


@pytest.mark.parametrize("seed", range(3))
def test_links_are_followed_to_the_end(spark, keep, seed):
    rng = random.Random(seed)
    name = [f"c{i:03d}" for i in range(200)]
    rng.shuffle(name)
    links = [(name[i], name[i + 1]) for i in range(60)] + [(rng.choice(name), rng.choice(name)) for _ in range(50)]
    links += [(name[150], n) for n in name[120:190]] + [(name[199], name[199])]
    got = closure.linked_groups(spark.createDataFrame(links, "a string, b string"), keep)
    assert sorted(map(tuple, got.collect())) == brute_groups(links)


def test_no_links(spark, keep):
    assert closure.linked_groups(spark.createDataFrame([], "a string, b string"), keep).collect() == []


def test_chains_over_both_bases_are_one_group(spark, keep):
    customers = linked_customers(SampleTables(spark, SMALL).stg_customers)
    groups = {r["customer_id"]: r for r in analyses.account_groups(customers, keep).collect()}
    # 18 and 19 share a name, 20 is billed to 19; 10 is billed to 9
    assert {groups[k]["group_id"] for k in ("18", "19", "20")} == {"18"} and groups["20"]["accounts"] == 3
    assert groups["18"]["by_name"] and groups["18"]["by_link"]
    assert groups["9"]["group_id"] == groups["10"]["group_id"] == "10" and not groups["9"]["by_name"]


def ranked_sample(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        score = rng.choice([0.0, 999.99, 1000.0, 1000.0, 4999.5, 5000.0, 12345.67, rng.random() * 20000])
        rows.append((i + 1, f"c{i}", rng.choice(["Ann", "Bob", "Eve"]), rng.choice(["North", "South", None]), rng.choice(["early_warning", "declining"]), round(score, 2), True))
    df = spark.createDataFrame(rows, "opportunity_rank int, customer_id string, salesperson string, home_branch_name string, opportunity_type string, s double, is_flagged boolean")
    for name in ("customer_name", "reason", "last_purchase_date", "days_since_last_purchase", "as_of_date"):
        df = df.withColumn(name, F.lit("x"))
    money = F.col("s").cast("decimal(18,4)")
    return df.withColumn("priority_score", money).withColumn("est_lost_gross_profit", (money * 2).cast("decimal(18,4)"))


def test_cells_give_the_totals_of_every_filter(spark, keep):
    opportunities = ranked_sample(spark)
    cells = keep(cube.cells(explore.ranked_list(opportunities)))
    assert cells.count() < 150
    kinds = ([()], [("Ann",), ("Bob", "Eve"), ()], [("North",), ()], [("Early warning",), ()], [0, 1000, 5000])
    for reps, homes, types, least in itertools.product(kinds[1], kinds[2], kinds[3], kinds[4]):
        want = explore.headline_totals(explore.ranked_list(opportunities, reps, homes, types, least)).first()
        assert tuple(cube.totals(cells, reps, homes, types, least).first()) == tuple(want)
    with pytest.raises(ValueError, match="steps of 1000"):
        cube.totals(cells, min_score=500)
    both = cube.all_totals(cells, (0, 1000)).filter("salesperson = '(all)' and home_branch_name = '(none)' and opportunity_type = 'Declining' and min_score = 1000").first()
    want = opportunities.filter("home_branch_name is null and opportunity_type = 'declining' and priority_score >= 1000")
    assert both["customers"] == want.count() > 0


def test_ranks_under_a_filter(spark, keep):
    ranked = explore.ranked_list(ranked_sample(spark))
    got = {r["customer_id"]: r for r in cube.ranks(ranked, keep(cube.cells(ranked))).collect()}
    rows = ranked.collect()
    for r in rows:
        for name in cube.FILTERS:
            assert got[r["customer_id"]][f"rank_in_{name}"] == 1 + sum(o[name] == r[name] and o["priority_score"] > r["priority_score"] for o in rows)
