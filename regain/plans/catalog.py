"""Every query by name: ``(spark, folder of sample tables) -> DataFrame``.

Most queries compose the lazy pipeline. Drill-downs and data-quality checks read finished tables, so
they run over a full build, made once per session and folder.
"""

from __future__ import annotations

import contextlib
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regain.config import EXTRACT_PATTERNS, Settings
from regain.functions.text import clean_text
from regain.operators import analyses, callsheet, cube, distinct, explore, history, marts, opportunity, quality, staging
from regain.plans import checks, versions
from regain.plans.load import load
from regain.plans.pipeline import CUSTOMERS, DAYS, DETAIL, LINES, SCORES, SEEDS, STAGING, Pipeline, build
from regain.plans.session import tune
from regain.plans.files import delete_folder, move_files
from regain.plans.gate import Gate
from regain.plans.store import Scratch
from regain.sources import extracts, untidy
from regain.sources.intake import FILES, Intake, load_changed
from regain.sources.sample import LOADED_AT, SampleTables
from regain.sources.tables import export_one_file

CFG = Settings()
Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, whole numbers as bigint, dates as ISO text, load stamps dropped."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            continue
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _lazy(make: Callable[[Pipeline], DataFrame], shared: frozenset = frozenset()) -> Query:
    def run(spark: SparkSession, path: str) -> DataFrame:
        # a query that corrects lines by their invoices reads the lines several times
        sample = SampleTables(spark, path, CFG, Scratch(tune(spark)).keep if "account_remap" in shared else None)
        return portable(make(Pipeline.for_query(spark, sample, CFG, shared)))

    return run


def sales_detail(spark: SparkSession, path: str) -> DataFrame:
    """Written a year at a time: a plan of the whole table holds every exchange of all lines until it ends."""
    root = Scratch(tune(spark)).root
    return _lazy(lambda p: p.sales_detail_by_year(root), shared=DETAIL)(spark, path)


_BUILT: dict[tuple[str, str], Pipeline] = {}


def built(spark: SparkSession, path: str) -> Pipeline:
    """The full build over one folder, written once per session."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _BUILT:
        _BUILT[key] = build(spark, SampleTables(spark, path, CFG), Scratch(spark).root, CFG)
    return _BUILT[key]


def _over_build(make: Callable[[Pipeline], DataFrame]) -> Query:
    return lambda spark, path: portable(make(built(spark, path)))


def _stage(make: Callable[[SampleTables], DataFrame]) -> Query:
    return lambda spark, path: portable(make(SampleTables(tune(spark), path, CFG)))


# ---- staging from raw text ---------------------------------------------------------------------


def _lookups(t: SampleTables) -> DataFrame:
    """The four lookups staged from raw text, stacked as (lookup, code, name, short name)."""
    parts = [
        ("branches", staging.stage_branches, t.stg_branches, staging.BRANCHES_TEXT, "branch_id", "branch_name", F.col("branch_short_name")),
        ("buylines", staging.stage_buylines, t.stg_buylines, staging.BUYLINES_TEXT, "buy_line", "buy_line_desc", None),
        ("gltypes", staging.stage_gltypes, t.stg_gltypes, staging.GLTYPES_TEXT, "gl_type", "gl_type_desc", None),
        ("salespeople", staging.stage_salespeople, t.stg_salespeople, staging.SALESPEOPLE_TEXT, "salesperson_id", "salesperson_name", None),
    ]
    out = None
    for name, stage, table, columns, code, label, short in parts:
        rows = stage(untidy.raw_lookup(table, columns), CFG).select(
            F.lit(name).alias("lookup"), F.col(code).alias("code"), F.col(label).alias("name"),
            (F.lit(None).cast("string") if short is None else short).alias("short_name"), "company_id",
        )
        out = rows if out is None else out.unionByName(rows)
    return out


# ---- ingest ------------------------------------------------------------------------------------

ROWS_PER_FILE = 50_000


def _write_document_extract(docs: DataFrame, folder: str) -> None:
    """Documents as tab-delimited files in mixed encodings: the input of the ingest queries.

    Every file starts with a header. Each data line carries the line number it is written to, so the
    numbers the reader finds can be compared with the truth. Latin-1 lines end in CR LF, and an
    empty line follows each document whose id is a multiple of seven.
    """
    files = max(8, math.ceil(docs.count() / ROWS_PER_FILE))
    repeat = F.when(F.col("doc_id") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    placed = (
        docs.select("doc_id", "lang", "source", "text", F.explode(repeat).alias("part"))
        .repartition(files).sortWithinPartitions("doc_id", "part")
        .withColumn("place", F.monotonically_increasing_id() % F.lit(1 << 33) + 2)
    )
    body = F.regexp_replace("text", r"[\t\r\n]+", " ")
    data = F.concat_ws("\t", F.col("doc_id").cast("string"), "lang", "source", F.col("place").cast("string"), body)
    latin = (F.col("doc_id") % 2 == 1) & F.col("text").rlike(r"^[\x00-\xFF]*$")
    line = (
        F.when(F.col("part") == 1, F.lit(""))
        .when(latin, F.concat(F.encode(data, "ISO-8859-1"), F.lit("\r").cast("binary")).cast("string"))
        .otherwise(data)
    )
    header = F.lit("Doc_ID\tLang\tSource\tPlace\tBody")
    lines = F.when(F.col("place") == 2, F.array(header, line)).otherwise(F.array(line))
    placed.select(F.explode(lines).alias("value")).write.mode("overwrite").text(folder)


def _document_extract(spark: SparkSession, path: str) -> DataFrame:
    scratch = Scratch(spark)
    folder = f"{scratch.root}/extract"
    _write_document_extract(spark.read.parquet(f"{path}/documents.parquet"), folder)
    return extracts.read_extract(spark, folder, "part-*.txt", LOADED_AT, scratch.keep, with_encoding=True)


def ingest_extract(spark: SparkSession, path: str) -> DataFrame:
    """Documents written as mixed-encoding extract files and read back with line lineage."""
    raw = _document_extract(spark, path)
    return raw.select(
        F.col("Doc_ID").cast("bigint").alias("doc_id"), F.col("Lang").alias("lang"), F.col("Source").alias("source"),
        F.col("Body").alias("body"), "encoding",
        (F.col("_source_line") - F.col("Place").cast("bigint")).cast("bigint").alias("line_offset"),
    )


def load_summary(spark: SparkSession, path: str) -> DataFrame:
    """Rows and Latin-1 lines over all files of the document extract."""
    summary = extracts.load_summary(_document_extract(spark, path))
    return summary.agg(F.sum("rows").alias("rows"), F.sum("latin1_lines").alias("latin1_lines"))


FIRST_LOAD, SECOND_LOAD = "2026-09-08 00:00:00", "2026-09-09 00:00:00"


def _two_deliveries(spark: SparkSession, path: str) -> Intake:
    """The documents as extract files per language, loaded; then the first language delivered again with other texts, and
    loaded again: the files of the other languages are not opened."""
    scratch = Scratch(spark)
    docs, folder = spark.read.parquet(f"{path}/documents.parquet"), f"{scratch.root}/in"
    langs = sorted(r[0] for r in docs.select("lang").distinct().collect() if r[0])  # a handful

    def deliver(lang: str, rows: DataFrame, parts: str) -> None:
        _write_document_extract(rows.filter(F.col("lang") == lang), parts)
        delete_folder(spark, f"{folder}/{lang}")
        move_files(spark, parts, f"{folder}/{lang}", lambda k: f"docs_{lang}_{k}.txt")

    def take(stamp: str) -> Intake:
        return load_changed(spark, folder, "docs_*.txt", f"{scratch.root}/raw", stamp, scratch.keep)

    for lang in langs:
        deliver(lang, docs, f"{scratch.root}/first/{lang}")
    take(FIRST_LOAD)
    again = docs.withColumn("text", F.concat(F.lit("second "), "text"))
    deliver(langs[0], again, f"{scratch.root}/second/{langs[0]}")
    return take(SECOND_LOAD)


def reload_changed(spark: SparkSession, path: str) -> DataFrame:
    """Every row of the second load, and which load read it."""
    raw = _two_deliveries(spark, path).table
    load = F.when(F.col("_loaded_at") == F.lit(SECOND_LOAD).cast("timestamp"), "second").otherwise("first")
    return raw.select(F.col("Doc_ID").cast("bigint").alias("doc_id"), F.col("Lang").alias("lang"), F.col("Body").alias("body"), load.alias("load"))


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """What became of the files of each language in the second load, with their rows."""
    rows = _two_deliveries(spark, path).as_rows("documents")
    files = spark.createDataFrame(rows, FILES).withColumn("lang", F.regexp_extract("file", "docs_(.*)_", 1))
    return files.groupBy("lang", "state").agg(F.sum("rows").alias("rows"), F.sum("latin1_lines").alias("latin1_lines"))


def table_versions(spark: SparkSession, path: str) -> DataFrame:
    """Orders per year as readers of three moments see them: opened on the first version, on the second (which was made from
    the first), and after a third was written but not accepted."""
    scratch = Scratch(tune(spark))
    table = f"{scratch.root}/orders"
    orders = SampleTables(spark, path, CFG).stg_orders.select("invoice_no", "ship_date", "item_total")
    early = F.col("ship_date") < F.lit("1998-01-01")

    def refuse(_: DataFrame) -> None:
        raise ValueError("not accepted")

    first = versions.put(orders.filter(early), table)
    second = versions.put(first.unionByName(orders.filter(~early)), table)
    with contextlib.suppress(ValueError):
        versions.put(orders.limit(0), table, accept=refuse)
    out = None
    for name, reader in (("first", first), ("second", second), ("current", versions.read(spark, table))):
        rows = reader.groupBy(F.year("ship_date").alias("sales_year")).agg(F.count("*").alias("rows"), F.sum("item_total").alias("item_total"))
        rows = rows.withColumn("opened_on", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return portable(out)


# every extract in as many files as there are parts, those with one exact file name, too; as text they take more disk than
# all tables made of them, so they are packed
PART_PATTERNS = {name: (p if "*" in p else p.replace(".txt", "_*.txt")) + ".gz" for name, p in EXTRACT_PATTERNS.items()}


def write_sample_extracts(spark: SparkSession, path: str, folder: str) -> None:
    """The sample as extract files under ``folder/extracts`` and seed files under ``folder/seeds``."""
    sample = SampleTables(tune(spark), path, CFG)
    for name, versions in untidy.sample_extracts(sample).items():
        for i, raw in enumerate(versions):
            part = f"{folder}/parts/{name}-{i}"
            untidy.write_extract(raw, part)
            move_files(spark, part, f"{folder}/extracts/{name}-{i}", lambda k: PART_PATTERNS[name].replace("*", f"{i}_{k}"))
    for name in SEEDS:
        rows = getattr(sample, name)
        rows.coalesce(1).write.csv(f"{folder}/parts/{name}", header=True)
        move_files(spark, f"{folder}/parts/{name}", f"{folder}/seeds", lambda k: f"{name}.csv")


def load_files(spark: SparkSession, path: str) -> DataFrame:
    """The customer mart, from extract and seed files to marts in one run."""
    root = Scratch(spark).root
    write_sample_extracts(spark, path, root)
    loaded = load(spark, f"{root}/extracts", f"{root}/seeds", f"{root}/tables", LOADED_AT, CFG, patterns=PART_PATTERNS)
    return portable(loaded.pipeline.customer_mart)


def _document_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the documents as bytes: odd documents in Latin-1 where their characters allow it."""
    docs = spark.read.parquet(f"{path}/documents.parquet")
    lines = docs.select("doc_id", "source", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    latin = (F.col("doc_id") % 2 == 1) & F.col("line").rlike(r"^[\x00-\xFF]*$")
    return lines.withColumn("value", F.when(latin, F.encode("line", "ISO-8859-1").cast("string")).otherwise(F.col("line")))


def decode_mixed(spark: SparkSession, path: str) -> DataFrame:
    lines = _document_lines(spark, path)
    return lines.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), extracts.decode_mixed(F.col("value")).alias("line"))


def encoding_profile(spark: SparkSession, path: str) -> DataFrame:
    return portable(analyses.encoding_profile(_document_lines(spark, path)))


def clean_text_query(spark: SparkSession, path: str) -> DataFrame:
    """Whole document texts, garbled and padded, then repaired."""
    docs = spark.read.parquet(f"{path}/documents.parquet")
    dirty = F.concat(F.lit("  "), F.regexp_replace("text", "'", untidy.GARBLED_APOSTROPHE), F.lit("\u0000 "))
    return docs.withColumn("dirty", dirty).select("doc_id", clean_text("dirty").alias("text"))


# ---- one customer, one filter, one file --------------------------------------------------------


def _first_page(make: Callable[[Pipeline, dict], DataFrame]) -> Query:
    """Views of the page as it opens: the customer ranked first is chosen."""
    return _over_build(lambda p: make(p, explore.first_of_list(p.opportunities)))


def _filtered_list(p: Pipeline, first: dict) -> DataFrame:
    return explore.ranked_list(p.opportunities, [first.get("salesperson")], [first.get("home_branch_name")], min_score=1000)


def export_list(spark: SparkSession, path: str) -> DataFrame:
    """The ranked list as its download file, read back line by line."""
    p, scratch = built(spark, path), Scratch(spark)
    ranked = explore.ranked_list(p.opportunities).drop("as_of_date")
    file = f"{scratch.root}/win_back_opportunities.csv"
    export_one_file(ranked, file, [F.col("opportunity_rank"), F.col("customer_id")])
    lines = extracts.numbered_lines(spark, [file], scratch.keep).filter("_source_line > 1")
    text = ", ".join(f"`{c}` string" for c in ranked.columns)
    parsed = F.from_csv("value", text, {"quote": '"', "escape": '"', "mode": "FAILFAST"})
    read = lines.select(F.col("_source_line").cast("bigint").alias("line_no"), parsed.alias("r")).select("line_no", "r.*")
    return read.select(
        "line_no", "customer_id", "customer_name", "salesperson", "home_branch_name", "reason", "last_purchase_date",
        F.col("priority_score").cast("double").alias("priority_score"),
    )


# ---- checks ------------------------------------------------------------------------------------


def dq_gate(spark: SparkSession, path: str) -> DataFrame:
    """Every declared check as a guarded build makes it, and what a build that stops on errors would do."""
    watch = Gate(stop=False)
    build(spark, SampleTables(spark, path, CFG), Scratch(spark).root, CFG, watch)
    action = F.when(F.col("failing_rows") == 0, "pass").when(F.col("severity") == "error", "stop").otherwise("warn")
    return watch.as_frame(spark).withColumn("action", action)



_TABLE_OF = {
    "int_sales_lines": "lines", "int_invoices": "invoices", "int_header_only_entries": "headers", "int_products": "products",
    "int_inventory_by_branch": "stock", "int_salespeople": "people", "int_buylines": "buylines",
    "int_customer_transactions": "transactions", "int_customer_groups": "groups",
    "int_customer_product_changes": "product_changes", "int_customer_brand_changes": "brand_changes",
    "mart_sales_detail": "sales_detail", "mart_customers": "customer_mart", "mart_products": "product_mart",
    "mart_inventory_by_branch": "inventory_mart", "mart_customer_years": "customer_years",
    "mart_opportunities": "opportunities", "mart_call_sheet": "call_sheet",
}


def table_map(p: Pipeline) -> dict[str, DataFrame]:
    tables = {name: getattr(p.staged, name) for name in (*STAGING, *SEEDS)}
    return tables | {name: getattr(p, attribute) for name, attribute in _TABLE_OF.items()}


def _customer_signal(*columns: str) -> Query:
    return _lazy(lambda p: p.scores.select("customer_id", *columns), shared=SCORES)


def _rolling(p: Pipeline, rows: DataFrame, owner: str, member: str, out: str) -> DataFrame:
    bought = rows.filter("is_purchase")
    numbers = distinct.dense_numbers(bought, member, p.keep)
    return distinct.rolling_distinct(p.keep(distinct.monthly_bitmaps(bought, owner, member, numbers)), owner, out)


def _rhythm(p: Pipeline) -> DataFrame:
    """Purchase days dealt to four loads at random, one of them loaded twice, merged."""
    load = F.pmod(F.xxhash64("customer_id", "ship_date"), F.lit(4))
    parts = [history.rhythm_states(p.days.filter(load == k)) for k in (2, 0, 3, 1, 2)]
    return history.rhythm_of_states(p.keep(history.merged_states(parts)))


def duplicate_line_proof(spark: SparkSession, path: str) -> DataFrame:
    """The lines are read to find the invoices, to compare them and for the headers: they are joined to their orders once."""
    keep = Scratch(tune(spark)).keep
    t = SampleTables(spark, path, CFG, keep)
    return portable(analyses.duplicate_line_proof(t.stg_sales, t.stg_orders, core=t.stg_sales_core, keep=keep))


def _recency(p: Pipeline) -> DataFrame:
    return marts.customer_recency(p.days, p.dates)


QUERIES: dict[str, Query] = {
    # sources
    "ingest_extract": ingest_extract,
    "load_summary": load_summary,
    "load_files": load_files,
    "reload_changed": reload_changed,
    "load_manifest": load_manifest,
    "table_versions": table_versions,
    "decode_mixed": decode_mixed,
    "encoding_profile": encoding_profile,
    "clean_text": clean_text_query,
    # staging
    "stage_sales": _stage(lambda t: staging.stage_sales(untidy.raw_sales(t.stg_sales), CFG)),
    "stage_orders": _stage(lambda t: staging.stage_orders(untidy.raw_orders(t.stg_orders), CFG)),
    "stage_customers": _stage(lambda t: staging.stage_customers(untidy.raw_customers(t.stg_customers), CFG)),
    "stage_products": _stage(lambda t: staging.stage_products(untidy.raw_products(t.stg_products), t.stg_gltypes, CFG)),
    "stage_inventory": _stage(lambda t: staging.stage_inventory(untidy.raw_inventory(t.stg_inventory), CFG)),
    "stage_purchases": _stage(lambda t: staging.stage_purchases(untidy.raw_purchases(t.stg_purchases), CFG)),
    "stage_lookups": _stage(_lookups),
    # rules
    "classify_lines": _lazy(lambda p: p.lines),
    "reconcile_invoices": _lazy(lambda p: p.invoices),
    "classify_headers": _lazy(lambda p: p.headers),
    "invoice_corrections": _lazy(lambda p: p.corrections),
    "customer_transactions": _lazy(lambda p: p.transactions),
    "customer_groups": _lazy(lambda p: p.groups),
    "map_buylines": _lazy(lambda p: p.buylines),
    "resolve_salespeople": _lazy(lambda p: p.people),
    "collapse_products": _lazy(lambda p: p.products),
    "inventory_by_branch": _lazy(lambda p: p.stock),
    "reporting_dates": _lazy(lambda p: p.dates_frame),
    "product_changes": _lazy(lambda p: p.product_changes),
    "brand_changes": _lazy(lambda p: p.brand_changes),
    # marts
    "sales_detail": sales_detail,
    "customer_mart": _lazy(lambda p: p.customer_mart, shared=CUSTOMERS),
    "customer_universe": _lazy(lambda p: marts.customer_universe(p.staged.stg_customers, p.groups, p.days, p.headers)),
    "customer_recency": _lazy(_recency),
    "customer_12m_change": _lazy(lambda p: marts.customer_12m_change(p.days, p.dates)),
    "buying_rhythm": _lazy(lambda p: marts.buying_rhythm(p.days, p.purchase_invoices, p.dates), shared=LINES),
    "customer_category_mix": _lazy(lambda p: marts.customer_category_mix(p.line_transactions, p.products)),
    "customer_header_money": _lazy(lambda p: marts.customer_header_money(p.headers, p.groups)),
    "linked_accounts": _lazy(lambda p: marts.linked_accounts(p.staged.stg_customers, p.groups)),
    "customer_years": _lazy(lambda p: p.customer_years, shared=CUSTOMERS),
    "product_mart": _lazy(lambda p: p.product_mart, shared=LINES),
    "inventory_mart": _lazy(lambda p: p.inventory_mart),
    # scoring
    "signal_declining": _customer_signal("is_two_year_decline", "is_sharp_drop", "is_declining", "lost_gp_declining"),
    "signal_behind": _customer_signal(
        "same_period_gp_last_year", "same_period_gp_this_year", "is_behind_this_year", "lost_gp_this_year"
    ),
    "signal_quiet": _customer_signal("has_rhythm", "gap_ratio", "is_gone_quiet", "lost_gp_gone_quiet"),
    "stopped_brands": _lazy(lambda p: p.stopped_brands),
    "opportunity_type": _customer_signal("opportunity_type"),
    "recoverability": _customer_signal("recoverability_factor"),
    "lost_profit": _customer_signal("lost_gp_declining", "lost_gp_this_year", "lost_gp_gone_quiet", "est_lost_gross_profit"),
    "winnability": _customer_signal("winnability_weight"),
    "opportunity_reason": _lazy(lambda p: p.scores.select("customer_id", opportunity.reason(p.dates).alias("reason")), shared=SCORES),
    "opportunities": _lazy(lambda p: p.opportunities, shared=SCORES),
    "product_stock": _lazy(lambda p: callsheet.product_stock(p.inventory_mart)),
    "call_sheet": _lazy(lambda p: p.call_sheet, shared=LINES),
    # drill-downs
    "ranked_list": _over_build(lambda p: explore.ranked_list(p.opportunities)),
    "headline_totals": _over_build(lambda p: explore.headline_totals(explore.ranked_list(p.opportunities))),
    "filter_values": _over_build(lambda p: explore.filter_values(p.opportunities)),
    "customer_contact": _over_build(lambda p: explore.customer_contact(p.customer_mart)),
    "customer_kpis": _over_build(lambda p: explore.customer_kpis(p.opportunities)),
    "monthly_profit": _over_build(lambda p: explore.monthly_profit(p.sales_detail, p.dates)),
    "yearly_profit": _over_build(lambda p: explore.yearly_profit(p.customer_years)),
    "top_brand_drops": _over_build(lambda p: explore.top_brand_drops(p.brand_changes)),
    "recent_invoices": _over_build(lambda p: explore.recent_invoices(p.sales_detail)),
    "sheet_by_brand": _over_build(lambda p: explore.sheet_by_brand(p.call_sheet)),
    "product_type_reference": _over_build(lambda p: explore.product_type_reference(p.product_mart)),
    # the page as it opens
    "ranked_list_filtered": _first_page(_filtered_list),
    "customer_page_months": _first_page(lambda p, first: explore.monthly_profit(p.sales_detail, p.dates, first.get("customer_id"), p.dates.prior_start)),
    "customer_page_invoices": _first_page(lambda p, first: explore.recent_invoices(p.sales_detail, first.get("customer_id"))),
    "customer_page_sheet": _first_page(lambda p, first: explore.sheet_by_brand(p.call_sheet, first.get("customer_id"))),
    "filter_totals": _over_build(lambda p: cube.all_totals(cube.cells(explore.ranked_list(p.opportunities)))),
    "filter_ranks": _over_build(lambda p: (lambda ranked: cube.ranks(ranked, cube.cells(ranked)))(explore.ranked_list(p.opportunities))),
    "export_list": export_list,
    # many dates at once
    "rolling_buyers": _lazy(lambda p: _rolling(p, p.money_lines, "product_id", "bill_to_customer_id", "buyers_12m")),
    "rolling_assortment": _lazy(lambda p: _rolling(p, p.line_transactions, "customer_id", "product_id", "products_12m")),
    "month_end_change": _lazy(lambda p: history.month_end_change(p.days, p.dates.as_of), shared=DAYS),
    "early_drop_by_month": _lazy(lambda p: history.early_drop_by_month(p.days, p.dates.as_of), shared=DAYS),
    "rhythm_states": _lazy(_rhythm, shared=DAYS),
    # data quality
    "dq_gate": dq_gate,
    "dq_unique": _over_build(lambda p: quality.unique(table_map(p), checks.UNIQUE, p.keep)),
    "dq_not_null": _over_build(lambda p: quality.not_null(table_map(p), checks.NOT_NULL)),
    "dq_accepted_values": _over_build(lambda p: quality.accepted_values(table_map(p), checks.ACCEPTED_VALUES)),
    "dq_relationships": _over_build(lambda p: quality.relationships(table_map(p), checks.RELATIONSHIPS, p.keep)),
    "dq_reconcile_headers": _over_build(lambda p: quality.reconcile_headers(p.transactions, p.headers, p.invoices)),
    "dq_tie_out": _over_build(lambda p: quality.tie_out(
        p.sales_detail, p.lines, p.headers, p.invoices, p.transactions, p.customer_mart, p.product_mart, p.customer_years
    )),
    "dq_same_across_branches": _stage(lambda t: quality.same_across_branches(untidy.differing_products(t.stg_products))),
    "dq_flagged_have_reason": _over_build(lambda p: quality.flagged_have_reason(untidy.without_some_reasons(p.opportunities))),
    # analyses
    "gap_multiples": _lazy(lambda p: analyses.gap_multiples(p.days, p.purchase_invoices, CFG), shared=LINES),
    "early_drop_predicts": _lazy(lambda p: analyses.early_drop_predicts(p.customer_years, p.dates), shared=CUSTOMERS),
    "duplicate_line_proof": duplicate_line_proof,
    "cost_basis_check": _lazy(lambda p: analyses.cost_basis_check(p.money_lines, p.staged.stg_purchases, p.keep)),
    "consignment_nets_zero": _lazy(lambda p: analyses.consignment_nets_zero(p.lines)),
    "buyline_near_duplicates": _stage(lambda t: analyses.buyline_near_duplicates(t.stg_buylines)),
    "related_accounts": _stage(lambda t: analyses.related_accounts(untidy.linked_customers(t.stg_customers))),
    "account_groups": _lazy(lambda p: analyses.account_groups(untidy.linked_customers(p.staged.stg_customers), p.keep)),
}
