"""One-off analyses behind the rules: do the thresholds and assumptions hold on the data?"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regain.config import Settings
from regain.functions.numbers import safe_div
from regain.functions.text import blank_to_null
from regain.operators.closure import linked_groups
from regain.operators.ranking import running_total
from regain.operators.windows import ReportingDates


def gap_multiples(days: DataFrame, invoices: DataFrame, cfg: Settings = Settings(), multiples: Sequence[int] = (2, 3, 4, 5)) -> DataFrame:
    """How many completed gaps between purchase days exceed a multiple of the customer's average gap.

    Customers with a usable rhythm only. The window runs over purchase days, so a customer's share of
    it is bounded by the calendar, not by the number of lines.
    """
    steady = (
        invoices.groupBy("customer_id", "invoice_no").agg(F.lit(1).alias("one")).groupBy("customer_id")
        .agg(F.count("*").alias("n")).filter(F.col("n") >= cfg.rhythm_min_invoices).select("customer_id")
    )
    bought = days.filter("purchased and ship_date is not null").select("customer_id", "ship_date").join(steady, "customer_id", "left_semi")
    gaps = bought.withColumn("gap", F.datediff("ship_date", F.lag("ship_date").over(Window.partitionBy("customer_id").orderBy("ship_date"))))
    gaps = gaps.filter("gap is not null")
    usual = gaps.groupBy("customer_id").agg(safe_div(F.sum("gap"), F.count("*")).alias("usual"))
    compared = gaps.join(usual, "customer_id")
    counts = compared.agg(
        F.count("*").alias("gaps"), *[F.count_if(F.col("gap") > m * F.col("usual")).alias(f"over_{m}") for m in multiples]
    )
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("multiple"), F.col(f"over_{m}").alias("gaps_over")) for m in multiples]))
    return counts.select("gaps", rows.alias("r")).select(
        "r.multiple", "gaps", "r.gaps_over", safe_div(F.col("r.gaps_over"), F.col("gaps")).alias("share")
    )


DROP_BANDS = ((0.40, "down 40%+"), (0.20, "down 20-40%"), (0.15, "down 15-20%"), (0.10, "down 10-15%"), (0.0, "down 0-10%"))


def drop_band(now: Column, before: Column) -> Column:
    """The name of the drop from ``before`` to ``now``."""
    drop = F.lit(1.0) - safe_div(now, before)
    band = F.when(drop >= DROP_BANDS[0][0], DROP_BANDS[0][1])
    for limit, name in DROP_BANDS[1:]:
        band = band.when(drop > limit if limit == 0.0 else drop >= limit, name)
    return band.otherwise("up or flat")


def early_drop_predicts(years: DataFrame, dates: ReportingDates, min_profit: int = 2000) -> DataFrame:
    """Complete years: how a drop by the as-of day compares with the result of the whole year."""
    before = years.select(
        "customer_id", (F.col("sales_year") + 1).alias("sales_year"),
        F.col("same_period_gross_profit").alias("same_before"), F.col("full_year_gross_profit").alias("full_before"),
    )
    pairs = years.filter(F.col("sales_year") < F.year(dates.as_of_col)).join(before, ["customer_id", "sales_year"])
    pairs = pairs.filter(F.col("same_before") >= min_profit)
    band = drop_band(F.col("same_period_gross_profit"), F.col("same_before"))
    now, was = F.col("full_year_gross_profit"), F.col("full_before")
    return (
        pairs.withColumn("band", band)
        .groupBy("band")
        .agg(F.count("*").alias("cases"), F.count_if(now < was).alias("ended_down"), F.count_if(now * 10 <= was * 9).alias("ended_down_10"))
        .withColumn("share_ended_down", safe_div(F.col("ended_down"), F.col("cases")))
        .withColumn("share_ended_down_10", safe_div(F.col("ended_down_10"), F.col("cases")))
    )


# what tells two lines apart that are otherwise the same
LINE_IDENTITY = ("sales_line_id", "_source_file", "_source_line", "_loaded_at")


def duplicate_line_proof(
    lines: DataFrame, orders: DataFrame, identity: Sequence[str] = LINE_IDENTITY, tolerance: float = 0.01,
    core: DataFrame | None = None, keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Invoices with equal priced lines: does the header match with the repeats, or without them?

    Lines are equal when every column but their identity is. Only invoices with lines that agree in a few columns are
    compared in all of them, and lines collapse to distinct content with a count, so repeats never meet in one task.
    ``core`` gives the same lines without descriptive columns, to look for those invoices in. ``keep`` may write them, and the
    invoices with repeats: then what was exchanged for a step goes before the next begins.
    """
    alike = (lines if core is None else core).filter("ext_price <> 0").groupBy("invoice_no", "product_id", "quantity", "ext_price").count()
    invoices = keep(alike.filter("count > 1").select("invoice_no").distinct())
    content = [c for c in lines.columns if c not in identity]
    per_line = lines.join(invoices, "invoice_no", "left_semi").groupBy(*content).agg(F.count("*").alias("copies"))
    per_invoice = per_line.groupBy("invoice_no").agg(
        F.sum(F.col("ext_price") * F.col("copies")).alias("with_repeats"),
        F.sum("ext_price").alias("without_repeats"),
        F.max(F.when(F.col("ext_price") != 0, F.col("copies"))).alias("most_copies"),
    )
    repeated = keep(per_invoice.filter("most_copies > 1"))
    joined = repeated.join(orders.select("invoice_no", "item_total"), "invoice_no")
    return joined.agg(
        F.count("*").alias("invoices"),
        F.count_if(F.abs(F.col("with_repeats") - F.col("item_total")) <= tolerance).alias("match_with_repeats"),
        F.count_if(F.abs(F.col("without_repeats") - F.col("item_total")) <= tolerance).alias("match_without_repeats"),
    )


def exact_median(df: DataFrame, group: str, value: str, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``group, median_<value>``: the middle value, or the mean of the two middle ones. Values are numbered by range, so
    no task holds all values of a group."""
    known = df.filter(F.col(value).isNotNull()).select(group, value)
    placed = running_total(known, [group], [F.col(value)], F.lit(1), "_before", keep)
    sizes = known.groupBy(group).agg(F.count("*").alias("_n"))
    middle = (F.col("_before") == F.floor((F.col("_n") - 1) / 2)) | (F.col("_before") == F.floor(F.col("_n") / 2))
    return placed.join(sizes, group).filter(middle).groupBy(group).agg(F.avg(value).alias(f"median_{value}"))


def cost_basis_check(lines: DataFrame, purchases: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Sold unit cost against purchase unit cost, same product and month: two candidate cost columns.

    Both sides are summed per product and month before the join; the medians are exact.
    """
    month = F.trunc("ship_date", "month").alias("month")
    sold = lines.filter("is_purchase and quantity > 0").groupBy("product_id", month).agg(
        F.sum("quantity").alias("sold"), F.sum("ext_cogs").alias("cogs"), F.sum("ext_cost").alias("cost")
    )
    bought = purchases.filter("quantity > 0").groupBy("product_id", F.trunc("received_date", "month").alias("month")).agg(
        F.sum("quantity").alias("bought"), F.sum("ext_purchase_cost").alias("paid")
    )
    pairs = sold.join(bought, ["product_id", "month"]).filter("paid <> 0")
    unit_paid = safe_div(F.col("paid"), F.col("bought"))
    ratios = keep(pairs.select(F.explode(F.array(*[
        F.struct(F.lit(basis).alias("basis"), (safe_div(F.col(basis), F.col("sold")) / unit_paid).alias("ratio")) for basis in ("cogs", "cost")
    ])).alias("r")).select("r.basis", "r.ratio"))
    shares = ratios.groupBy("basis").agg(
        F.count("*").alias("pairs"),
        safe_div(F.count_if(F.abs(F.col("ratio") - 1) <= 0.05), F.count("*")).alias("share_within_5_pct"),
    )
    return shares.join(exact_median(ratios, "basis", "ratio", keep), "basis", "left")


def consignment_nets_zero(lines: DataFrame) -> DataFrame:
    """Share of customer and product pairs whose consignment transfers sum to zero units."""
    moves = lines.filter(F.col("line_type") == "consignment_transfer")
    pairs = moves.groupBy("bill_to_customer_id", "product_id").agg(F.sum("quantity").alias("net"))
    counts = pairs.agg(F.count("*").alias("pairs"), F.count_if(F.col("net") == 0).alias("net_zero"))
    return counts.withColumn("share", safe_div(F.col("net_zero"), F.col("pairs")))


def buyline_near_duplicates(buylines: DataFrame) -> DataFrame:
    """Brand codes that share a description, ignoring case and spaces."""
    key = F.regexp_replace(F.upper("buy_line_desc"), r"\s+", " ")
    named = buylines.filter("buy_line_desc is not null").select("buy_line", blank_to_null(key).alias("description"))
    return named.groupBy("description").agg(
        F.expr("listagg(buy_line, ', ') within group (order by buy_line)").alias("buy_lines"), F.count("*").alias("codes")
    ).filter("codes > 1")


NAME_NOISE = r"\([^)]*\)|\b(INC|LLC|CO|CORP)\b|[^A-Z0-9# ]"


def related_accounts(customers: DataFrame) -> DataFrame:
    """Candidate groups: accounts sharing a normalised name, and accounts the master bills elsewhere.

    Candidates for review only; what is merged stays in the seed.
    """
    key = F.regexp_replace(F.regexp_replace(F.upper("customer_name"), NAME_NOISE, " "), r"\s+", " ")
    named = customers.select("customer_id", "bill_to_customer_id", blank_to_null(key).alias("name_key"))
    sizes = named.filter("name_key is not null").groupBy("name_key").agg(F.count("*").alias("accounts"), F.min("customer_id").alias("first_account"))
    by_name = named.join(sizes.filter("accounts > 1"), "name_key").select(
        F.lit("same name").alias("basis"), "customer_id", F.col("first_account").alias("related_to"), "accounts"
    )
    by_link = named.filter("bill_to_customer_id <> customer_id").select(
        F.lit("master link").alias("basis"), "customer_id", F.col("bill_to_customer_id").alias("related_to"), F.lit(2).cast("bigint").alias("accounts")
    )
    return by_name.unionByName(by_link)


def account_groups(customers: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Candidate groups closed over both bases: every account that names and master links, taken together, lead to.

    One row per account of a group of several: the smallest account is the group's id, with the group's size and the
    bases that hold it together. Accounts of one name are linked to its first account, so a common name costs one link each.
    """
    related = keep(related_accounts(customers).select("basis", F.col("customer_id").alias("a"), F.col("related_to").alias("b")))
    groups = keep(linked_groups(related, keep))
    bases = related.filter("a <> b").join(groups, F.col("a") == F.col("account")).groupBy("group").agg(
        F.bool_or(F.col("basis") == "same name").alias("by_name"), F.bool_or(F.col("basis") == "master link").alias("by_link")
    )
    sizes = groups.groupBy("group").agg(F.count("*").alias("accounts"))
    out = groups.join(sizes.filter("accounts > 1"), "group").join(bases, "group")
    return out.select(F.col("account").alias("customer_id"), F.col("group").alias("group_id"), "accounts", "by_name", "by_link")


def encoding_profile(lines: DataFrame) -> DataFrame:
    """Per source: lines, lines not valid as UTF-8, and lines with a quote character.

    Expects ``source`` and ``value`` as read, before decoding.
    """
    return lines.groupBy("source").agg(
        F.count("*").alias("lines"),
        F.count_if(~F.is_valid_utf8("value")).alias("latin1_lines"),
        F.count_if(F.contains(F.col("value").cast("binary"), F.lit('"').cast("binary"))).alias("quoted_lines"),
    )
