"""The tables of the model as one lazily composed graph.

``Pipeline`` names every table once. What happens to a table after it is composed is decided by
``table``: a full build writes each one to its layer and goes on from the written copy; a single
query leaves them lazy, except the few that several branches of its plan would recompute.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regain.config import Settings
from regain.operators import callsheet, dimensions, marts, opportunity, rules, windows
from regain.plans import versions
from regain.plans.gate import Gate
from regain.plans.session import tune
from regain.plans.store import Layers, Scratch

STAGING = (
    "stg_sales", "stg_orders", "stg_customers", "stg_products", "stg_inventory", "stg_purchases", "stg_branches",
    "stg_buylines", "stg_gltypes", "stg_salespeople",
)
SEEDS = ("seed_buyline_map", "seed_customer_groups", "seed_system_accounts")
MARTS = (
    "mart_sales_detail", "mart_customers", "mart_customer_years", "mart_products", "mart_inventory_by_branch",
    "mart_opportunities", "mart_call_sheet",
)
LAYER_OF = {**dict.fromkeys(STAGING, "staging"), **dict.fromkeys(SEEDS, "seeds"), **dict.fromkeys(MARTS, "marts")}

# one customer's rows of a year lie in few files; the line id lets a customer with very many rows take several
DETAIL_LAYOUT = versions.Layout(
    derive={"ship_year": "year(ship_date)"}, partition_by=("ship_year",), range_by=("ship_year", "customer_id", "sales_line_id"),
    no_dictionary=("sales_line_id", "invoice_no", "order_id", "customer_id", "_source_line"),
)
# tables that meet on the invoice
BY_INVOICE = ("int_sales_lines", "int_invoices")
ROWS_PER_BUCKET, MOST_UNEVEN = 500_000, 4.0
ROWS_PER_CUSTOMER_BUCKET = 500_000  # a task aggregates the days, invoices and products of a bucket's customers in memory
LINE_TURNS = 2  # the lines are exchanged in halves
# of tables sorted by invoice; a name a table does not have is no matter
NEAR_INVOICE = (
    "sales_line_id", "transaction_id", "invoice_no", "order_id", "bill_to_customer_id", "ship_to_customer_id", "product_id", "_source_line",
)
LAYOUTS = {
    "stg_sales": versions.Layout(sort_by=("invoice_no",), no_dictionary=NEAR_INVOICE),
    "stg_orders": versions.Layout(sort_by=("invoice_no",), no_dictionary=("invoice_no", "_source_line")),
    "int_customer_transactions": versions.Layout(sort_by=("invoice_no",), no_dictionary=(*NEAR_INVOICE, "customer_id")),
    "mart_sales_detail": DETAIL_LAYOUT,
}

# what the money tables read of the lines
MONEY_COLUMNS = (
    "sales_line_id", "company_id", "invoice_no", "bill_to_customer_id", "ship_to_customer_id", "product_id", "sell_group",
    "ship_date", "quantity", "ext_price", "ext_cost", "ext_cogs", "customer_po", "gross_profit", "is_financial",
    "is_purchase", "is_return_credit", "is_consignment",
)

# Tables a query writes and reads back. Some are read by several branches of its plan; the others
# split a plan of many joins, which adaptive execution would otherwise re-plan whole after each stage,
# and keep the work already done when executors are lost.
# Only those of the detail have a row per line; where the sample's lines are read several times, it writes those itself.
INVOICES = frozenset({"int_invoices"})
# the accounts that belong to another customer are few: written, Spark knows their size, and lines need no exchange to meet them
LINES = INVOICES | {"invoice_exceptions", "account_remap"}
DAYS = frozenset({"account_remap", "customer_days"})
# The detail is made a year at a time: its lookups are written, or each year would make them again, and exchange its lines to
# meet those whose size is not known.
DETAIL = LINES | {"int_sales_lines", "int_salespeople", "int_products", "int_customer_groups"}
CUSTOMERS = frozenset({
    "account_remap", "invoice_exceptions", "customer_days", "purchase_invoices", "int_customer_product_changes", "buyers", "scores",
})
# A customer's days lie together where several aggregates per customer read them: else each customer has days in every
# task, and their partial sums are no fewer than the days. There is one row a day, so a customer's are bounded.
TOGETHER = {"customer_days": ("customer_id",)}
# Scoring writes the transactions in buckets of customers, with the columns it reads. All that it aggregates per customer
# and something else comes from them without an exchange, so invoices and products are not written. It reads the exceptions
# once, so what it does not read of them is not exchanged.
SCORES = (CUSTOMERS - {"invoice_exceptions"}) | {"int_customer_transactions"}
OF_BUCKETS = frozenset({"purchase_invoices", "int_customer_product_changes"})
DETAIL_COLUMNS = (  # what the detail reads of the lines
    "sales_line_id", "company_id", "invoice_no", "ship_date", "bill_to_customer_id", "ship_to_customer_id",
    "outside_salesperson_id", "inside_salesperson_id", "price_branch_id", "ship_branch_id", "sales_source", "customer_po",
    "_source_file", "_source_line", "order_date", "order_to_ship_days", "product_id", "product_desc", "sell_group", "line_type",
    "is_financial", "is_purchase", "is_consignment", "is_return_credit", "quantity", "ext_price", "ext_cost", "ext_cogs",
    "gross_profit",
)
SCORED_COLUMNS = (
    "customer_id", "transaction_type", "invoice_no", "ship_date", "product_id", "quantity", "ext_price", "gross_profit",
    "is_financial", "is_purchase", "is_return_credit", "is_consignment",
)


def _in_buckets(rows: DataFrame, root: str, lines_lie: versions.Layout) -> DataFrame | None:
    """What lines look up by invoice, written under ``root`` in the buckets the lines lie in, if they do."""
    if lines_lie.bucket_by is None:
        return None
    return versions.put(rows, f"{root}/invoice_accounts", versions.Layout(bucket_by="met_invoice_no", buckets=lines_lie.buckets))


class Pipeline:
    """``staged`` offers the staging and seed tables as attributes of these names.

    Where it also offers ``stg_sales_core`` (lines without descriptive columns), money-only tables
    read that instead.
    """

    def __init__(
        self, staged, settings: Settings = Settings(), table: Callable[[str, DataFrame], DataFrame] | None = None,
        keep: Callable[[DataFrame], DataFrame] | None = None, built: bool = False,
        by_customer: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
        by_invoice: Callable[[DataFrame], DataFrame | None] = lambda rows: None,
    ):
        self.staged = staged
        self.cfg = settings
        self._table = table or (lambda _name, df: df)
        self._keep = keep
        self.built = built
        self._by_customer = by_customer
        self._by_invoice = by_invoice  # writes what lines look up in their buckets; gives None where they lie in none

    @classmethod
    def for_query(cls, spark, staged, settings: Settings = Settings(), shared: frozenset = frozenset()) -> "Pipeline":
        """Lazy tables; those named in ``shared`` are written once and read back."""
        scratch = Scratch(tune(spark))
        bucketed = False

        def by_customer(rows: DataFrame, sized_by: DataFrame) -> DataFrame:
            nonlocal bucketed
            layout = versions.even_buckets([sized_by], "customer_id", ROWS_PER_CUSTOMER_BUCKET, MOST_UNEVEN)
            bucketed = layout.bucket_by is not None
            return Layers(scratch.root, layouts={"int_customer_transactions": layout}).put("int_customer_transactions", rows)

        lines_lie = versions.PLAIN

        def lines_by_invoice(df: DataFrame) -> DataFrame:
            nonlocal lines_lie
            sized_by = getattr(staged, "stg_sales_core", df)
            lines_lie = versions.even_buckets([sized_by], "invoice_no", ROWS_PER_BUCKET, MOST_UNEVEN)
            df = df.select(*DETAIL_COLUMNS)
            return versions.put(df, f"{scratch.root}/int_sales_lines", replace(lines_lie, turns=LINE_TURNS if lines_lie.bucket_by else 1))

        def table(name: str, df: DataFrame) -> DataFrame:
            if name not in shared or (bucketed and name in OF_BUCKETS):
                return df
            if name == "int_sales_lines":
                return lines_by_invoice(df)
            apart = name in TOGETHER and "scores" in shared and not bucketed
            return scratch.keep(df.repartition(*TOGETHER[name]) if apart else df)

        return cls(
            staged, settings, table, scratch.keep, by_customer=by_customer if "int_customer_transactions" in shared else None,
            by_invoice=lambda rows: _in_buckets(rows, scratch.root, lines_lie),
        )

    @property
    def keep(self):
        if self._keep is None:
            raise ValueError("this table needs a place to write intermediate rows: pass keep")
        return self._keep

    # ---- lines and invoices -----------------------------------------------------------------

    @cached_property
    def lines(self) -> DataFrame:
        return self._table("int_sales_lines", rules.classify_lines(self.staged.stg_sales, self.cfg))

    @cached_property
    def money_lines(self) -> DataFrame:
        core = getattr(self.staged, "stg_sales_core", None)
        if core is None:
            return self.lines
        return self._table("money_lines", rules.money_flags(core, self.cfg).select(*MONEY_COLUMNS))

    @cached_property
    def invoices(self) -> DataFrame:
        return self._table("int_invoices", rules.reconcile_invoices(self.staged.stg_orders, self.money_lines, self.cfg))

    @cached_property
    def headers(self) -> DataFrame:
        return self._table("int_header_only_entries", rules.classify_headers(self.exceptions, self.cfg))

    @cached_property
    def exceptions(self) -> DataFrame:
        """Invoices that do not match their lines: the few rows headers and corrections are made of."""
        frame = self.invoices.filter(F.col("reconciliation_status") != "matched")
        return self._table("invoice_exceptions", frame)

    @cached_property
    def corrections(self) -> DataFrame:
        return rules.invoice_corrections(self.exceptions)

    @cached_property
    def dates_frame(self) -> DataFrame:
        return self._table("int_reporting_dates", windows.reporting_dates(self.money_lines))

    @cached_property
    def dates(self) -> windows.ReportingDates:
        return windows.ReportingDates.read(self.dates_frame)

    # ---- dimensions -------------------------------------------------------------------------

    @cached_property
    def groups(self) -> DataFrame:
        frame = dimensions.customer_groups(self.staged.stg_customers, self.staged.seed_customer_groups)
        return self._table("int_customer_groups", frame)

    @cached_property
    def remap(self) -> DataFrame:
        frame = dimensions.account_remap(self.staged.stg_customers, self.staged.seed_customer_groups)
        return self._table("account_remap", frame)

    @cached_property
    def buylines(self) -> DataFrame:
        s = self.staged
        return self._table(
            "int_buylines", dimensions.map_buylines(s.stg_buylines, s.stg_products, s.seed_buyline_map, self.cfg)
        )

    @cached_property
    def people(self) -> DataFrame:
        s = self.staged
        frame = dimensions.resolve_salespeople(s.stg_salespeople, s.stg_sales, s.stg_customers, s.seed_system_accounts, self.cfg)
        return self._table("int_salespeople", frame)

    @cached_property
    def products(self) -> DataFrame:
        s = self.staged
        return self._table("int_products", dimensions.collapse_products(s.stg_products, s.stg_gltypes, self.buylines))

    @cached_property
    def stock(self) -> DataFrame:
        return self._table("int_inventory_by_branch", dimensions.inventory_by_branch(self.staged.stg_inventory))

    # ---- customers --------------------------------------------------------------------------

    @cached_property
    def line_transactions(self) -> DataFrame:
        if self._by_customer is not None:
            return self.transactions.filter(F.col("transaction_type") == "product_line")
        return rules.line_transactions(self.money_lines, self.remap)

    @cached_property
    def transactions(self) -> DataFrame:
        extra = rules.exception_transactions(self.exceptions, self.remap, self.cfg)
        if self._by_customer is not None:
            of_lines = rules.line_transactions(self.money_lines, self.remap)
            return self._by_customer(rules.customer_transactions(of_lines, extra).select(*SCORED_COLUMNS), of_lines)
        return self._table("int_customer_transactions", rules.customer_transactions(self.line_transactions, extra))

    @cached_property
    def days(self) -> DataFrame:
        return self._table("customer_days", windows.customer_days(self.transactions))

    @cached_property
    def purchase_invoices(self) -> DataFrame:
        return self._table("purchase_invoices", windows.purchase_invoices(self.line_transactions))

    @cached_property
    def product_changes(self) -> DataFrame:
        frame = windows.product_changes(self.line_transactions, self.products, self.dates, self.cfg)
        return self._table("int_customer_product_changes", frame)

    @cached_property
    def brand_changes(self) -> DataFrame:
        return self._table("int_customer_brand_changes", windows.brand_changes(self.product_changes, self.cfg))

    @cached_property
    def customer_years(self) -> DataFrame:
        frame = windows.customer_years(self.days, self.purchase_invoices, self.dates, self.cfg)
        return self._table("mart_customer_years", frame)

    @cached_property
    def customer_mart(self) -> DataFrame:
        frame = marts.customer_mart(
            self.line_transactions, self.days, self.purchase_invoices, self.headers, self.staged.stg_customers, self.groups,
            self.people, self.staged.stg_branches, self.products, self.dates,
        )
        return self._table("mart_customers", frame)

    @cached_property
    def buyers(self) -> DataFrame:
        """What scoring reads of the customers: the finished mart in a build, otherwise only those columns."""
        if self.built:
            return self.customer_mart
        s = self.staged
        frame = marts.buyers(self.days, self.purchase_invoices, s.stg_customers, self.people, s.stg_branches, self.dates)
        return self._table("buyers", frame)

    # ---- other marts ------------------------------------------------------------------------

    @cached_property
    def sales_detail(self) -> DataFrame:
        if self.built:  # written a year at a time, each made of the lines, headers and corrections of its year
            whole, parts = self._detail_parts()
            return self._table("mart_sales_detail", whole, parts)
        return self._table("mart_sales_detail", self._detail(keep=self._keep or (lambda df: df)))

    def sales_detail_by_year(self, root: str) -> DataFrame:
        """The same rows for a query, written under ``root`` as a build writes them, but in no order."""
        whole, parts = self._detail_parts()
        written = versions.put(whole, f"{root}/mart_sales_detail", replace(DETAIL_LAYOUT, range_by=()), part=parts)
        return written.select(*whole.columns)

    def _detail_parts(self) -> tuple[DataFrame, Callable[[Column], DataFrame]]:
        """All rows, and those of a year made of the lines, headers and corrections of that year."""
        found = self._by_invoice(marts.invoice_accounts(
            self.lines, self.headers, self.corrections, self.invoices, self.staged.stg_customers, self.groups
        ))
        whole = self._detail(found=found)

        def of(same: Column) -> DataFrame:
            return self._detail(lambda rows: rows.filter(same), found=found)

        return whole, of if found is None else versions.Parts(of, found.select("ship_date"))

    def _detail(self, of=lambda rows: rows, keep=lambda df: df, found: DataFrame | None = None) -> DataFrame:
        s = self.staged
        return marts.sales_detail(
            of(self.lines), of(self.headers), of(self.corrections), self.invoices, s.stg_customers, self.groups, self.people,
            s.stg_branches, self.products, keep, found if found is None else of(found),
        )

    @cached_property
    def product_mart(self) -> DataFrame:
        return self._table("mart_products", marts.product_mart(self.money_lines, self.products, self.stock, self.dates))

    @cached_property
    def inventory_mart(self) -> DataFrame:
        frame = dimensions.inventory_mart(self.stock, self.products, self.staged.stg_branches, self.cfg)
        return self._table("mart_inventory_by_branch", frame)

    @cached_property
    def stopped_brands(self) -> DataFrame:
        return opportunity.stopped_brands(self.brand_changes, self.cfg)

    @cached_property
    def signals(self) -> DataFrame:
        return opportunity.signals(self.buyers, self.customer_years, self.stopped_brands, self.dates, self.cfg)

    @cached_property
    def scores(self) -> DataFrame:
        return self._table("scores", opportunity.scored(self.signals, self.cfg))

    @cached_property
    def opportunities(self) -> DataFrame:
        frame = opportunity.opportunities(self.scores, self.dates, self.keep, self.cfg)
        return self._table("mart_opportunities", frame)

    @cached_property
    def call_sheet(self) -> DataFrame:
        homes = self.staged.stg_customers.select("customer_id", "home_branch_id").join(
            self.staged.stg_branches.select(F.col("branch_id").alias("home_branch_id"), F.col("branch_name").alias("home_branch_name")),
            "home_branch_id", "left",
        )
        # customers come from transactions, so all of them are in the customer mart; only the home
        # branch is needed, and it may be missing for an account the master does not know
        everyone = self.product_changes.filter("is_mostly_stopped").select("customer_id").distinct()
        homes = everyone.join(homes, "customer_id", "left")
        names = self.products.select("product_id", "product_desc", F.col("gl_type_desc").alias("product_type_desc"))
        catalogue = names.join(callsheet.product_prices(self.money_lines, self.dates), "product_id", "left")
        frame = callsheet.call_sheet(self.product_changes, homes, catalogue, self.inventory_mart, self.cfg)
        return self._table("mart_call_sheet", frame)


# Tables whose steps exchange the lines come as soon as they can, while few others stand beside what they exchange.
BUILD_ORDER = (
    "lines", "invoices", "headers", "dates_frame", "groups", "buylines", "people", "products", "stock", "product_mart",
    "sales_detail", "transactions", "days", "purchase_invoices", "product_changes", "brand_changes", "customer_years",
    "customer_mart", "inventory_mart", "scores", "opportunities", "call_sheet",
)
LAST_STAGED = ("stg_purchases",)  # no table of the build is made of it, so it is written after them


class Written:
    """Staging and seed tables read back from their layers."""

    def __init__(self, tables: dict[str, DataFrame]):
        self.__dict__.update(tables)


def build(spark, staged, root: str, settings: Settings = Settings(), gate: Gate | None = None) -> Pipeline:
    """Write every staging, intermediate and mart table under ``root`` and return the pipeline over them.

    Each table is a version of its own (see ``plans/versions.py``): a reader of an earlier build is not disturbed. With a
    ``gate`` every table is checked as it is written; one that fails is not committed, and the build stops there.
    """
    tune(spark)
    layers = Layers(root, LAYER_OF, dict(LAYOUTS))
    put = layers.put if gate is None else gate.guarding(layers)
    written = Written({name: put(name, getattr(staged, name)) for name in (*SEEDS, *STAGING) if name not in LAST_STAGED})
    by_invoice = versions.even_buckets([written.stg_sales, written.stg_orders], "invoice_no", ROWS_PER_BUCKET, MOST_UNEVEN)
    by_invoice = replace(by_invoice, sort_by=() if by_invoice.bucket_by else ("invoice_no",), no_dictionary=NEAR_INVOICE)
    layers.layouts.update(dict.fromkeys(BY_INVOICE, by_invoice))
    if by_invoice.bucket_by:
        layers.layouts["int_sales_lines"] = replace(by_invoice, turns=LINE_TURNS)
    scratch = Scratch(spark)

    def put_alone(name: str, df: DataFrame, part: Callable[[Column], DataFrame] | None = None) -> DataFrame:
        """What a table wrote on its way goes once the table stands."""
        done = put(name, df, part)
        scratch.close()
        return done

    pipeline = Pipeline(
        written, settings, put_alone, scratch.keep, built=True, by_invoice=lambda rows: _in_buckets(rows, scratch.root, by_invoice)
    )
    for name in BUILD_ORDER:
        getattr(pipeline, name)
    written.__dict__.update({name: put(name, getattr(staged, name)) for name in LAST_STAGED})
    return pipeline
