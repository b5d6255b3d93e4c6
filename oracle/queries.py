"""The expected result of each query, as DuckDB SQL over the sample tables.

Output columns are portable types: money and ratios as double, counts as bigint, dates as ISO text.
"""

from __future__ import annotations

from oracle import declared
from oracle.models import with_models

DATES = set(
    "ship_date order_date required_date received_date last_payment_date as_of_date first_purchase_date last_purchase_date "
    "first_sold_date last_sold_date month last_12m_start prior_12m_start month_end".split()
)
WHOLE = set(
    "quantity units order_to_ship_days item_count header_item_count line_count usage_count warehouse_qty consignment_qty other_qty "
    "total_onhand_qty consignment_customer_count committed_qty sales_365_days hits_365_days onhand_qty pil units_prior_12m units_last_12m "
    "sales_year full_year_purchase_invoices days_since_last_purchase purchase_day_count purchase_invoice_count purchase_invoices_last_12m "
    "brands_bought_count ship_to_account_count days_since_last_sold customers_last_12m lifetime_units branches_with_stock available_qty "
    "erp_units_sold_365_days erp_order_hits_365_days stopped_brand_count opportunity_rank product_rank available_home_branch "
    "available_all_branches best_branch_available customers position lines brands_sold_last_12m failing_rows avg_debtor_days buy_pack target "
    "_source_line doc_id line_no rows latin1_lines quoted_lines line_offset multiple gaps gaps_over cases ended_down ended_down_10 invoices "
    "match_with_repeats match_without_repeats pairs net_zero codes accounts "
    "buyers_12m products_12m longest_gap gaps_over_2x gaps_over_4x min_score rank_in_salesperson rank_in_home_branch_name "
    "rank_in_opportunity_type month_no".split()
)
MONEY = set(
    "ext_price ext_cost ext_cogs ext_price_change ext_weight gross_profit item_total cost_total cogs_total sales_tax freight_billed_in "
    "freight_billed_out freight_expense_in freight_expense_out handling_billed_in handling_billed_out handling_expense_in handling_expense_out "
    "last_payment_amount credit_limit credit_used demand_per_month ext_purchase_cost header_item_total header_cogs_total line_price_total "
    "line_cogs_total line_variance charge_amount rebate_amount adjustment_amount header_cogs warehouse_value total_value gp_prior_12m gp_last_12m "
    "full_year_sales full_year_gross_profit same_period_sales same_period_gross_profit sales_last_12m sales_prior_12m sales_change_12m "
    "gross_profit_last_12m gross_profit_prior_12m lifetime_sales lifetime_gross_profit lifetime_returns lifetime_charges lifetime_adjustments "
    "lifetime_rebates revenue cogs revenue_last_12m lifetime_revenue priority_score est_lost_gross_profit gp_oldest_complete_year "
    "gp_middle_complete_year gp_latest_complete_year same_period_gp_last_year same_period_gp_this_year lost_gp_declining lost_gp_this_year "
    "lost_gp_gone_quiet stopped_brands_gp_prior_12m sales expected_recoverable gross_profit_change_12m same_period_change detail_total "
    "header_total actual expected".split()
)
RATIOS = set(
    "margin_pct sales_change_12m_pct lifetime_margin_pct avg_days_between_purchases avg_order_value avg_unit_price_last_12m "
    "avg_unit_cogs_last_12m inventory_unit_cost last_unit_price winnability_weight recoverability_factor gap_ratio avg_units_per_month_before "
    "current_typical_price share share_ended_down share_ended_down_10 median_ratio share_within_5_pct".split()
)


def _column(name: str) -> str:
    kind = (
        "varchar" if name in DATES else "bigint" if name in WHOLE
        else "decimal(18,4)) as double" if name in MONEY else "double" if name in RATIOS else None
    )
    if kind is None:
        return f'"{name}"'
    if name in MONEY:
        return f'cast(cast("{name}" as decimal(18,4)) as double) as "{name}"'
    return f'cast("{name}" as {kind}) as "{name}"'


def out(source: str, columns: str) -> str:
    return with_models(f"select {', '.join(_column(n) for n in columns.split())} from {source}")


LINE_COLUMNS = (
    "sales_line_id company_id invoice_no order_id bill_to_customer_id ship_to_customer_id product_id product_desc product_status sell_group "
    "outside_salesperson_id inside_salesperson_id writer_id price_branch_id ship_branch_id ship_via sales_source "
)
SALES_COLUMNS = LINE_COLUMNS + (
    "order_status ship_date order_date required_date quantity ext_price ext_cost ext_cogs ext_price_change ext_weight customer_po is_direct_ship "
    "is_price_override is_cogs_override is_cost_override is_manual_override override_sign cost_flag cost_contract_id price_flag "
    "price_contract_id _source_file _source_line"
)
CLASSIFIED_COLUMNS = LINE_COLUMNS + (
    "ship_date order_date required_date order_to_ship_days quantity ext_price ext_cost ext_cogs gross_profit ext_weight customer_po line_type "
    "is_financial is_consignment is_return_credit is_purchase is_direct_ship is_price_override is_cogs_override is_cost_override "
    "is_manual_override price_contract_id cost_contract_id _source_file _source_line"
)
HEADER_COLUMNS = (
    "invoice_no company_id bill_to_customer_id ship_to_customer_id outside_salesperson_id inside_salesperson_id price_branch_id ship_branch_id "
    "sales_source customer_po ship_date "
)
SCORE = "m_scored"

ORACLE: dict[str, str] = {}

# ---- sources -----------------------------------------------------------------------------------

ORACLE["ingest_extract"] = r"""
select cast(doc_id as bigint) as doc_id, lang, source, nullif(regexp_replace(text, '[\t\r\n]+', ' ', 'g'), '') as body,
  case when doc_id % 2 = 1 and regexp_full_match(text, '[\x{00}-\x{FF}]*', 's') and not regexp_full_match(text, '[\x{00}-\x{7F}]*', 's')
       then 'latin-1' else 'utf-8' end as encoding, cast(0 as bigint) as line_offset from documents"""
ORACLE["load_summary"] = f"""
select cast(count(*) as bigint) as rows, cast(count(*) filter (encoding = 'latin-1') as bigint) as latin1_lines from ({ORACLE['ingest_extract']})"""
_DOC_LINES = r"""select doc_id, source, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line_no from documents"""
ORACLE["decode_mixed"] = f"select cast(doc_id as bigint) as doc_id, cast(line_no as bigint) as line_no, line from ({_DOC_LINES})"
ORACLE["encoding_profile"] = rf"""
select source, cast(count(*) as bigint) as lines,
  cast(count(*) filter (doc_id % 2 = 1 and regexp_full_match(line, '[\x{{00}}-\x{{FF}}]*', 's') and not regexp_full_match(line, '[\x{{00}}-\x{{7F}}]*', 's')) as bigint) as latin1_lines,
  cast(count(*) filter (contains(line, '"')) as bigint) as quoted_lines from ({_DOC_LINES}) group by source"""
ORACLE["clean_text"] = r"""
select cast(doc_id as bigint) as doc_id,
  nullif(trim(replace(text, chr(160), ' '), ' '), '') as text from documents"""

# ---- staging -----------------------------------------------------------------------------------

ORACLE["stage_sales"] = out(
    "(select * replace (_source_file || ':' || _source_line as sales_line_id) from s_sales)", SALES_COLUMNS
)
ORACLE["stage_orders"] = out(
    "s_orders",
    "invoice_no company_id bill_to_customer_id ship_to_customer_id outside_salesperson_id inside_salesperson_id writer_id price_branch_id "
    "ship_branch_id ship_via sales_source manifest_no customer_po ship_date item_count item_total cost_total cogs_total sales_tax "
    "freight_billed_in freight_billed_out freight_expense_in freight_expense_out handling_billed_in handling_billed_out handling_expense_in "
    "handling_expense_out _source_file _source_line",
)
ORACLE["stage_customers"] = out(
    "(select * replace (customer_name || '''s cafá' as customer_name) from s_customers)",
    "customer_id company_id bill_to_customer_id customer_name address_1 address_2 city state zip phone fax email salesperson_id "
    "inside_salesperson_id home_branch_id customer_type customer_class terms_code is_inactive last_payment_date last_payment_amount "
    "credit_limit credit_used avg_debtor_days _source_file _source_line",
)
ORACLE["stage_products"] = out(
    "s_products",
    "product_branch_id company_id product_id branch_id product_desc product_desc_2 buy_line price_line gl_type is_non_product product_status "
    "select_code commodity_code is_kit keywords upc mfr_catalog_no related_products buy_pack target_type target _source_file _source_line",
)
ORACLE["stage_inventory"] = out(
    "(select * replace (_source_file || ':' || _source_line as inventory_row_id) from s_inventory)",
    "inventory_row_id company_id product_id branch_id bin_location as_of_date buy_line price_line gl_type sell_group commodity_code "
    "product_status stock_type onhand_qty committed_qty ext_cost ext_cogs ext_weight pil demand_per_month sales_365_days hits_365_days "
    "rank_1 rank_2 rank_3 rank_4 rank_5 _source_file _source_line",
)
ORACLE["stage_purchases"] = out(
    "s_purchases",
    "purchase_line_id company_id po_no order_id vendor_id pay_to_vendor_id product_id product_desc product_status buy_group buyer_id "
    "writer_id order_branch_id receive_branch_id ship_via order_status order_date required_date received_date quantity ext_purchase_cost "
    "ext_weight _source_file _source_line",
)
ORACLE["stage_lookups"] = with_models("""
select 'branches' as lookup, branch_id as code, branch_name as name, branch_short_name as short_name, company_id from s_branches
union all select 'buylines', buy_line, buy_line_desc, null, company_id from s_buylines
union all select 'gltypes', gl_type, gl_type_desc, null, company_id from s_gltypes
union all select 'salespeople', salesperson_id, salesperson_name, null, company_id from s_people""")

# ---- rules -------------------------------------------------------------------------------------

ORACLE["classify_lines"] = out("m_lines", CLASSIFIED_COLUMNS)
ORACLE["reconcile_invoices"] = out(
    "m_invoices",
    HEADER_COLUMNS + "header_item_count header_item_total header_cogs_total sales_tax freight_billed_out handling_billed_out line_count "
    "line_price_total line_cogs_total line_variance reconciliation_status _source_file _source_line",
)
ORACLE["classify_headers"] = out(
    "m_headers",
    "sales_line_id " + HEADER_COLUMNS + "line_type entry_group charge_amount rebate_amount adjustment_amount header_cogs is_financial "
    "_source_file _source_line",
)
ORACLE["invoice_corrections"] = out(
    "m_corrections", "transaction_id " + HEADER_COLUMNS + "ext_price ext_cogs gross_profit _source_file _source_line"
)
ORACLE["customer_transactions"] = out(
    "m_tx",
    "transaction_id company_id bill_to_customer_id invoice_no ship_date transaction_type product_id quantity ext_price ext_cogs gross_profit "
    "is_financial is_purchase is_return_credit is_consignment customer_id",
)
ORACLE["customer_groups"] = out("m_groups", "account_id company_id customer_id grouping_reason")
ORACLE["map_buylines"] = out(
    "m_buylines", "buy_line company_id buy_line_desc is_in_lookup mapped_buy_line mapping_confidence mapping_note"
)
ORACLE["resolve_salespeople"] = out(
    "m_people", "salesperson_id company_id salesperson_name person_id person_name is_system_account is_in_lookup usage_count"
)
ORACLE["collapse_products"] = out(
    "m_products",
    "product_id company_id product_desc product_desc_2 gl_type gl_type_desc buy_line mapped_buy_line buy_line_desc price_line is_non_product "
    "product_status commodity_code select_code is_kit keywords upc mfr_catalog_no",
)
ORACLE["inventory_by_branch"] = out(
    "m_stock",
    "product_id branch_id as_of_date warehouse_qty consignment_qty other_qty total_onhand_qty warehouse_value total_value "
    "consignment_customer_count committed_qty demand_per_month sales_365_days hits_365_days warehouse_bin_locations",
)
ORACLE["reporting_dates"] = out(
    "(select as_of as as_of_date, l0 as last_12m_start, p0 as prior_12m_start from m_dates)", "as_of_date last_12m_start prior_12m_start"
)
CHANGE_COLUMNS = "gp_prior_12m gp_last_12m units_prior_12m units_last_12m last_purchase_date last_unit_price is_mostly_stopped"
ORACLE["product_changes"] = out("m_changes", "customer_id product_id brand brand_desc " + CHANGE_COLUMNS)
ORACLE["brand_changes"] = out(
    "m_brands", "customer_id brand brand_desc gp_prior_12m gp_last_12m last_purchase_date is_mostly_stopped"
)

# ---- marts -------------------------------------------------------------------------------------

ORACLE["sales_detail"] = out(
    "m_detail",
    "sales_line_id company_id row_source ship_date order_date order_to_ship_days invoice_no reconciliation_status has_invoice_variance "
    "customer_id customer_name bill_to_customer_id bill_to_customer_name ship_to_customer_id ship_to_customer_name outside_salesperson_id "
    "outside_salesperson inside_salesperson_id inside_salesperson ship_branch_id ship_branch_name price_branch_id sales_source product_id "
    "product_desc product_type product_type_desc brand brand_desc sell_group line_type is_financial is_purchase is_consignment "
    "is_return_credit quantity units revenue cogs gross_profit margin_pct ext_cost charge_amount adjustment_amount customer_po "
    "_source_file _source_line",
)
ORACLE["customer_mart"] = out(
    "m_customers",
    "customer_id account_ids company_id customer_name city state phone email customer_type customer_class home_branch_id home_branch_name "
    "salesperson_id salesperson_name is_house_account is_inactive ship_to_account_count purchase_status first_purchase_date "
    "last_purchase_date days_since_last_purchase sales_last_12m sales_prior_12m sales_change_12m sales_change_12m_pct "
    "gross_profit_last_12m gross_profit_prior_12m lifetime_margin_pct lifetime_sales lifetime_gross_profit lifetime_returns "
    "purchase_invoice_count purchase_invoices_last_12m avg_days_between_purchases avg_order_value product_types_bought "
    "brands_bought_count has_consignment_billing lifetime_charges lifetime_adjustments lifetime_rebates as_of_date",
)
ORACLE["customer_universe"] = out("m_universe", "customer_id")
_SEEN = "(select c.* from m_customers c where exists (select 1 from m_tx x where x.customer_id = c.customer_id))"
ORACLE["customer_recency"] = out(
    _SEEN, "customer_id first_purchase_date last_purchase_date purchase_status days_since_last_purchase"
)
ORACLE["customer_12m_change"] = out(
    _SEEN,
    "customer_id sales_last_12m sales_prior_12m sales_change_12m sales_change_12m_pct gross_profit_last_12m gross_profit_prior_12m",
)
ORACLE["buying_rhythm"] = out(
    "(select c.*, s.purchase_day_count from m_customers c join m_custsales s on s.customer_id = c.customer_id)",
    "customer_id purchase_day_count purchase_invoice_count purchase_invoices_last_12m avg_days_between_purchases avg_order_value",
)
ORACLE["customer_category_mix"] = out(
    "(select customer_id, types as product_types_bought, brands as brands_bought_count from m_mix)",
    "customer_id product_types_bought brands_bought_count",
)
ORACLE["customer_header_money"] = out("m_headmoney", "customer_id lifetime_charges lifetime_adjustments lifetime_rebates")
ORACLE["linked_accounts"] = out("m_linked", "customer_id account_ids ship_to_account_count")
ORACLE["customer_years"] = out(
    "m_years",
    "customer_year_id company_id customer_id sales_year is_partial_year same_period_label full_year_sales full_year_gross_profit "
    "full_year_purchase_invoices same_period_sales same_period_gross_profit",
)
ORACLE["product_mart"] = out(
    "m_prodmart",
    "product_id company_id product_desc product_desc_2 product_type product_type_desc brand brand_desc raw_buy_line sell_group is_non_product "
    "product_status is_kit mfr_catalog_no upc avg_unit_price_last_12m avg_unit_cogs_last_12m inventory_unit_cost first_sold_date "
    "last_sold_date days_since_last_sold units_last_12m revenue_last_12m gross_profit_last_12m customers_last_12m lifetime_units "
    "lifetime_margin_pct lifetime_revenue lifetime_gross_profit warehouse_qty consignment_qty branches_with_stock is_active "
    "is_currently_stocked as_of_date",
)
ORACLE["inventory_mart"] = out(
    "m_invmart",
    "product_branch_id company_id product_id product_desc product_type_desc brand branch_id branch_name as_of_date warehouse_qty "
    "consignment_qty other_qty committed_qty available_qty warehouse_value warehouse_bin_locations consignment_customer_count "
    "demand_per_month erp_units_sold_365_days erp_order_hits_365_days",
)

# ---- scoring -----------------------------------------------------------------------------------

_SCORED = (
    "(select customer_id, two as is_two_year_decline, sharp as is_sharp_drop, declining as is_declining, lost1 as lost_gp_declining, "
    "was as same_period_gp_last_year, now as same_period_gp_this_year, behind as is_behind_this_year, lost2 as lost_gp_this_year, "
    "rhythm as has_rhythm, ratio as gap_ratio, quiet as is_gone_quiet, lost3 as lost_gp_gone_quiet, kind as opportunity_type, "
    "recov as recoverability_factor, win as winnability_weight, lost as est_lost_gross_profit from m_scored)"
)
ORACLE["signal_declining"] = out(_SCORED, "customer_id is_two_year_decline is_sharp_drop is_declining lost_gp_declining")
ORACLE["signal_behind"] = out(
    _SCORED, "customer_id same_period_gp_last_year same_period_gp_this_year is_behind_this_year lost_gp_this_year"
)
ORACLE["signal_quiet"] = out(_SCORED, "customer_id has_rhythm gap_ratio is_gone_quiet lost_gp_gone_quiet")
ORACLE["stopped_brands"] = out("m_stopped", "customer_id stopped_brand_count stopped_brands_gp_prior_12m stopped_brands")
ORACLE["opportunity_type"] = out(_SCORED, "customer_id opportunity_type")
ORACLE["recoverability"] = out(_SCORED, "customer_id recoverability_factor")
ORACLE["lost_profit"] = out(
    _SCORED, "customer_id lost_gp_declining lost_gp_this_year lost_gp_gone_quiet est_lost_gross_profit"
)
ORACLE["winnability"] = out(_SCORED, "customer_id winnability_weight")
ORACLE["opportunity_reason"] = out("m_opps", "customer_id reason")
ORACLE["opportunities"] = out(
    "m_opps",
    "customer_id company_id customer_name salesperson home_branch_name is_flagged opportunity_rank opportunity_type priority_score "
    "est_lost_gross_profit winnability_weight recoverability_factor reason is_declining is_two_year_decline is_sharp_drop "
    "is_behind_this_year is_gone_quiet gp_oldest_complete_year gp_middle_complete_year gp_latest_complete_year same_period_gp_last_year "
    "same_period_gp_this_year gross_profit_prior_12m gross_profit_last_12m last_purchase_date days_since_last_purchase "
    "avg_days_between_purchases gap_ratio lost_gp_declining lost_gp_this_year lost_gp_gone_quiet stopped_brands stopped_brand_count "
    "stopped_brands_gp_prior_12m purchase_status as_of_date",
)
ORACLE["product_stock"] = out("m_prodbest", "product_id available_all_branches best_branch best_branch_available")
SHEET_COLUMNS = (
    "status product_desc brand_desc gp_prior_12m gp_last_12m avg_units_per_month_before last_purchase_date last_unit_price "
    "current_typical_price available_home_branch available_all_branches best_branch best_branch_available"
)
ORACLE["call_sheet"] = out(
    "m_sheet",
    "call_sheet_id company_id customer_id product_id product_rank product_type_desc brand units_prior_12m units_last_12m home_branch_name " + SHEET_COLUMNS,
)

# the same customers, whether the tables are the sample's own or come from extract files
ORACLE["load_files"] = ORACLE["customer_mart"]

# ---- drill-downs -------------------------------------------------------------------------------

_LABELLED = (
    "(select * replace (map {'early_warning': 'Early warning', 'declining': 'Declining', 'recovering': 'Recovering'}[opportunity_type] "
    "as opportunity_type) from m_opps where is_flagged)"
)
ORACLE["ranked_list"] = out(
    _LABELLED,
    "opportunity_rank customer_id customer_name salesperson home_branch_name opportunity_type priority_score est_lost_gross_profit reason "
    "last_purchase_date days_since_last_purchase as_of_date",
)
ORACLE["headline_totals"] = out(
    "(select count(*) as customers, sum(est_lost_gross_profit) as est_lost_gross_profit, sum(priority_score) as expected_recoverable from m_opps where is_flagged)",
    "customers est_lost_gross_profit expected_recoverable",
)
ORACLE["filter_values"] = with_models("""
select distinct 'salesperson' as filter, salesperson as value from m_opps where is_flagged
union select 'home_branch', home_branch_name from m_opps where is_flagged and home_branch_name is not null""")
ORACLE["customer_contact"] = with_models("""
select customer_id, customer_name, nullif(concat_ws(', ', city, state), '') as location, phone, email,
  case when account_ids like '%,%' then account_ids end as linked_accounts from m_customers""")
ORACLE["customer_kpis"] = out(
    "(select *, gross_profit_last_12m - gross_profit_prior_12m as gross_profit_change_12m, "
    "same_period_gp_this_year - same_period_gp_last_year as same_period_change from m_opps)",
    "customer_id last_purchase_date days_since_last_purchase avg_days_between_purchases gross_profit_last_12m gross_profit_change_12m "
    "same_period_gp_this_year same_period_change",
)
ORACLE["monthly_profit"] = out(
    "(select customer_id, cast(date_trunc('month', ship_date) as date) as month, sum(gross_profit) as gross_profit, "
    "date_trunc('month', ship_date) = date_trunc('month', any_value(as_of)) and any_value(as_of) <> last_day(any_value(as_of)) as is_partial_month "
    "from m_detail, m_dates where is_financial and customer_id is not null group by customer_id, date_trunc('month', ship_date))",
    "customer_id month gross_profit is_partial_month",
)
ORACLE["yearly_profit"] = out("m_years", "customer_id sales_year full_year_gross_profit same_period_gross_profit is_partial_year")
ORACLE["top_brand_drops"] = out(
    "(select customer_id, row_number() over (partition by customer_id order by gp_last_12m - gp_prior_12m, brand) as position, "
    "brand as brand_code, coalesce(brand_desc, brand) as brand, gp_prior_12m, gp_last_12m, is_mostly_stopped from m_brands "
    "qualify row_number() over (partition by customer_id order by gp_last_12m - gp_prior_12m, m_brands.brand) <= 15)",
    "customer_id position brand_code brand gp_prior_12m gp_last_12m is_mostly_stopped",
)
ORACLE["recent_invoices"] = out(
    # every customer's invoices as one ordered list, cut at fifteen and laid out again
    "(with part as (select customer_id, invoice_no, ship_date, ship_branch_name, row_source = 'product_line' as is_line, revenue, gross_profit "
    "from m_detail where is_financial and customer_id is not null), "
    "bill as (select customer_id as c, {'d': ship_date, 'i': invoice_no, 'b': ship_branch_name, 'n': sum(is_line::int), 's': sum(revenue), "
    "'p': sum(gross_profit)} as x from part group by customer_id, invoice_no, ship_date, ship_branch_name), "
    "lists as (select c, list(x order by x.d desc, x.i, x.b nulls last) as xs from bill group by c), "
    "laid as (select c, k, xs[k] as x from lists, unnest(range(1, least(len(xs), 15) + 1)) as r(k)) "
    "select c as customer_id, x.d as ship_date, x.i as invoice_no, x.b as ship_branch_name, x.n as lines, x.s as sales, x.p as gross_profit, "
    "k as position from laid)",
    "customer_id ship_date invoice_no ship_branch_name lines sales gross_profit position",
)
ORACLE["sheet_by_brand"] = out("(select * from m_sheet where product_rank <= 10)", "customer_id product_rank " + SHEET_COLUMNS)
ORACLE["product_type_reference"] = out(
    # a brand's place is one more than the brands of its type that sell more, or as much under an earlier name
    "(with sold as (select product_type as t, product_type_desc as d, coalesce(brand_desc, brand) as name, sum(revenue_last_12m) as money from m_prodmart "
    "where product_type is not null and not coalesce(is_non_product, true) group by t, d, name), "
    "placed as (select a.*, 1 + count(z.t) as place from sold a left join sold z on z.t = a.t and z.d is not distinct from a.d "
    "and (z.money > a.money or z.money = a.money and z.name < a.name) group by a.t, a.d, a.name, a.money), "
    "top as (select t, d, string_agg(name, ', ' order by place) as names from placed where place <= 5 group by t, d) "
    "select p.t as product_type, p.d as product_type_desc, sum((money > 0)::int) as brands_sold_last_12m, sum(money) as revenue_last_12m, "
    "any_value(names) as top_brands from placed p left join top on top.t = p.t and top.d is not distinct from p.d group by p.t, p.d)",
    "product_type product_type_desc brands_sold_last_12m revenue_last_12m top_brands",
)

# ---- data quality ------------------------------------------------------------------------------

MODEL_OF = {
    "stg_sales": "s_sales", "stg_orders": "s_orders", "stg_customers": "s_customers", "stg_products": "s_products",
    "stg_inventory": "s_inventory", "stg_purchases": "s_purchases", "stg_branches": "s_branches", "stg_buylines": "s_buylines",
    "stg_gltypes": "s_gltypes", "stg_salespeople": "s_people", "seed_buyline_map": "d_brandmap", "seed_customer_groups": "d_groups",
    "seed_system_accounts": "d_system", "int_sales_lines": "m_lines", "int_invoices": "m_invoices", "int_header_only_entries": "m_headers",
    "int_products": "m_products", "int_inventory_by_branch": "m_stock", "int_salespeople": "m_people", "int_buylines": "m_buylines",
    "int_customer_transactions": "m_tx", "int_customer_groups": "m_groups", "int_customer_product_changes": "m_changes",
    "int_customer_brand_changes": "m_brands", "mart_sales_detail": "m_detail", "mart_customers": "m_customers",
    "mart_products": "m_prodmart", "mart_inventory_by_branch": "m_invmart", "mart_customer_years": "m_years",
    "mart_opportunities": "m_opps", "mart_call_sheet": "m_sheet",
}


def _check(check: str, table: str, column: str, severity: str, rows: str, sample: str, source: str) -> str:
    return (
        f"select '{check}' as \"check\", '{table}' as \"table\", '{column}' as \"column\", '{severity}' as severity, "
        f"cast({rows} as bigint) as failing_rows, cast({sample} as varchar) as sample_key from {source}"
    )


ORACLE["dq_unique"] = with_models(" union all ".join(
    _check("unique", t, k, "error", "count(*)", "min(k)",
           f"(select {k}::varchar as k from {MODEL_OF[t]} where {k} is not null group by {k} having count(*) > 1)")
    for t, k in declared.UNIQUE
))
ORACLE["dq_not_null"] = with_models(" union all ".join(
    _check("not_null", t, k, "error", f"count(*) - count({k})", "null", MODEL_OF[t]) for t, ks in declared.NOT_NULL.items() for k in ks
))
ORACLE["dq_accepted_values"] = with_models(" union all ".join(
    _check("accepted_values", t, k, "error", "count(*)", f"min({k})",
           f"{MODEL_OF[t]} where {k} not in ({', '.join(chr(39) + v + chr(39) for v in vs)})")
    for t, k, vs in declared.ACCEPTED_VALUES
))
ORACLE["dq_relationships"] = with_models(" union all ".join(
    _check("relationships", t, k, severity, "count(*)", f"min({k})",
           f"{MODEL_OF[t]} where {k} is not null and {k} not in (select {pk} from {MODEL_OF[p]} where {pk} is not null)")
    for t, k, p, pk, severity in declared.RELATIONSHIPS
))
ORACLE["dq_reconcile_headers"] = out(
    "(select d as detail_total, h as header_total, abs(d - h) <= 1.00 as is_ok from (select "
    "(select sum(ext_price) from m_tx where transaction_type <> 'rebate') + (select sum(charge_amount + adjustment_amount + rebate_amount) from m_headers) as d, "
    "(select sum(item_total) from s_orders) as h))",
    "detail_total header_total is_ok",
)
# what each table contributes to which side of which check; sides are then added up
_TIES = (
    ("row count", "actual", "count(*)", "m_detail"),
    ("row count", "expected", "count(*)", "m_lines"),
    ("row count", "expected", "count(*)", "m_headers"),
    ("row count", "expected", "count(*)", "m_corrections"),
    ("detail revenue", "actual", "sum(revenue)", "m_detail"),
    ("detail revenue", "expected", "sum(ext_price)", "m_tx"),
    ("customer lifetime sales", "actual", "sum(lifetime_sales)", "m_customers"),
    ("customer lifetime sales", "expected", "sum(revenue)", "m_detail where is_financial"),
    ("product lifetime revenue", "actual", "sum(lifetime_revenue)", "m_prodmart"),
    ("product lifetime revenue", "expected", "sum(revenue)", "m_detail where is_financial and row_source = 'product_line'"),
    ("customer-year sales", "actual", "sum(full_year_sales)", "m_years"),
    ("customer-year sales", "expected", "sum(revenue)", "m_detail where is_financial"),
)
ORACLE["dq_tie_out"] = out(
    "(with side as (" + " union all ".join(
        f"select '{check}' as check_name, '{side}' as side, cast({amount} as decimal(30,4)) as amount from {source}"
        for check, side, amount, source in _TIES
    ) + "), sums as (pivot side on side in ('actual', 'expected') using sum(amount) group by check_name) "
    "select *, actual - expected between -0.01 and 0.01 as is_ok from sums)",
    "check_name actual expected is_ok",
)
ORACLE["dq_same_across_branches"] = with_models("""
select product_id from (select * replace (
    if(branch_id = '1' and product_id::bigint % 40 = 3, product_desc || ' (old)', product_desc) as product_desc,
    if(branch_id = '1' and product_id::bigint % 40 = 5, null, price_line) as price_line) from s_products)
  group by product_id having count(distinct (coalesce(product_desc, ''), coalesce(product_desc_2, ''),
  coalesce(buy_line, ''), coalesce(price_line, ''), coalesce(gl_type, ''), coalesce(product_status, ''), coalesce(commodity_code, ''), is_kit)) > 1""")
ORACLE["dq_flagged_have_reason"] = with_models(
    # every twentieth reason is taken out, the next is emptied, the next loses its rank
    "select customer_id from m_opps where is_flagged and (opportunity_rank % 20 in (1, 2, 3) or opportunity_rank is null or coalesce(reason, '') = '')"
)

# ---- analyses ----------------------------------------------------------------------------------

ORACLE["gap_multiples"] = out(
    "(with d as (select distinct customer_id, ship_date from m_tx where is_purchase and customer_id in "
    "(select customer_id from m_custsales where inv >= 5)), "
    "g as (select customer_id, date_diff('day', lag(ship_date) over (partition by customer_id order by ship_date), ship_date) as gap from d), "
    "u as (select *, avg(gap) over (partition by customer_id) as usual from g where gap is not null) "
    "select multiple, count(*) as gaps, count(*) filter (gap > multiple * usual) as gaps_over, "
    "count(*) filter (gap > multiple * usual)::double / count(*) as share from u, (select unnest([2, 3, 4, 5]) as multiple) group by multiple)",
    "multiple gaps gaps_over share",
)
ORACLE["early_drop_predicts"] = out(
    "(with p as (select n.full_year_gross_profit as f, b.full_year_gross_profit as fb, b.same_period_gross_profit as sb, "
    "1.0::double - n.same_period_gross_profit::decimal(18,4)::double / b.same_period_gross_profit::decimal(18,4)::double as dr "
    "from m_years n join m_years b on b.customer_id = n.customer_id and b.sales_year = n.sales_year - 1 cross join m_dates "
    "where n.sales_year < year(as_of) and b.same_period_gross_profit >= 2000) "
    "select case when dr >= 0.40::double then 'down 40%+' when dr >= 0.20::double then 'down 20-40%' when dr >= 0.15::double then 'down 15-20%' "
    "when dr >= 0.10::double then 'down 10-15%' when dr > 0 then 'down 0-10%' else 'up or flat' end as band, count(*) as cases, "
    "count(*) filter (f < fb) as ended_down, count(*) filter (f * 10 <= fb * 9) as ended_down_10, "
    "count(*) filter (f < fb)::double / count(*) as share_ended_down, count(*) filter (f * 10 <= fb * 9)::double / count(*) as share_ended_down_10 "
    "from p group by 1)",
    "band cases ended_down ended_down_10 share_ended_down share_ended_down_10",
)
ORACLE["duplicate_line_proof"] = out(
    "(with d as (select * exclude (sales_line_id, _source_file, _source_line), count(*) as n from s_sales group by all), "
    "i as (select invoice_no, sum(n * ext_price) as a, sum(ext_price) as b from d group by 1 having max(case when ext_price <> 0 then n end) > 1) "
    "select count(*) as invoices, count(*) filter (abs(a - item_total) <= 0.01) as match_with_repeats, "
    "count(*) filter (abs(b - item_total) <= 0.01) as match_without_repeats from i join s_orders using (invoice_no))",
    "invoices match_with_repeats match_without_repeats",
)
ORACLE["cost_basis_check"] = out(
    "(with s as (select product_id, date_trunc('month', ship_date) as m, sum(quantity) as q, sum(ext_cogs)::decimal(18,4)::double as cogs, "
    "sum(ext_cost)::decimal(18,4)::double as cost from m_lines where is_purchase and quantity > 0 group by all), "
    "b as (select product_id, date_trunc('month', received_date) as m, sum(quantity) as bq, sum(ext_purchase_cost)::decimal(18,4)::double as paid "
    "from s_purchases where quantity > 0 group by all having sum(ext_purchase_cost) <> 0), "
    "r as (select unnest(['cogs', 'cost']) as basis, unnest([cogs, cost]) / q::double / (paid / bq::double) as ratio from s join b using (product_id, m)) "
    "select basis, count(*) as pairs, median(ratio) as median_ratio, count(*) filter (abs(ratio - 1) <= 0.05)::double / count(*) as share_within_5_pct "
    "from r group by basis)",
    "basis pairs median_ratio share_within_5_pct",
)
ORACLE["consignment_nets_zero"] = out(
    "(select count(*) as pairs, count(*) filter (net = 0) as net_zero, count(*) filter (net = 0)::double / nullif(count(*), 0) as share from "
    "(select sum(quantity) as net from m_lines where line_type = 'consignment_transfer' group by bill_to_customer_id, product_id))",
    "pairs net_zero share",
)
ORACLE["buyline_near_duplicates"] = out(
    "(select upper(buy_line_desc) as description, string_agg(buy_line, ', ' order by buy_line) as buy_lines, count(*) as codes from s_buylines "
    "group by 1 having count(*) > 1)",
    "description buy_lines codes",
)
# some accounts are billed to the account before them
_LINKED = (
    "(select * replace (if(customer_id::bigint % 30 = 10 or customer_id::bigint % 60 = 20, (customer_id::bigint - 1)::varchar, bill_to_customer_id) "
    "as bill_to_customer_id) from s_customers)"
)
_RELATED = (
    f"(with c as {_LINKED} select 'same name' as basis, a.customer_id, min(b.customer_id) as related_to, count(*) as accounts from c a join c b "
    "on regexp_replace(a.customer_name, ' \\(.*', '') = regexp_replace(b.customer_name, ' \\(.*', '') group by a.customer_id having count(*) > 1 "
    "union all select 'master link', customer_id, bill_to_customer_id, 2 from c where bill_to_customer_id <> customer_id)"
)
ORACLE["related_accounts"] = out(_RELATED, "basis customer_id related_to accounts")
ORACLE["account_groups"] = out(
    f"(with recursive l as materialized {_RELATED}, e as (select basis, customer_id as a, related_to as b from l union all "
    "select basis, related_to, customer_id from l), "
    "r as (select a as id, a as seen from e union select r.id, e.b from r join e on e.a = r.seen), "
    "g as (select id, min(seen) as g from r group by id) "
    "select id as customer_id, g.g as group_id, n as accounts, by_name, by_link from g join "
    "(select g, count(*) as n from g group by g having count(*) > 1) using (g) join "
    "(select g, bool_or(basis = 'same name') as by_name, bool_or(basis = 'master link') as by_link from l join g on id = customer_id "
    "where customer_id <> related_to group by g) using (g))",
    "customer_id group_id accounts by_name by_link",
)

# ---- loads and versions ------------------------------------------------------------------------

_SECOND = "(select min(lang) from documents where lang <> '')"
ORACLE["reload_changed"] = f"""
select doc_id, lang, if(lang = {_SECOND} and text is not null, 'second ' || coalesce(body, ''), body) as body,
  if(lang = {_SECOND}, 'second', 'first') as load from ({ORACLE['ingest_extract']}) join (select doc_id, text from documents) using (doc_id)"""
ORACLE["load_manifest"] = f"""
select lang, if(lang = {_SECOND}, 'changed', 'same') as state, cast(count(*) as bigint) as rows,
  cast(count(*) filter (encoding = 'latin-1') as bigint) as latin1_lines from ({ORACLE['ingest_extract']}) group by lang"""
ORACLE["table_versions"] = out(
    "(select opened_on, year(ship_date) as sales_year, count(*) as rows, sum(item_total) as item_total from s_orders, "
    "(select unnest(['first', 'second', 'current']) as opened_on) where opened_on <> 'first' or ship_date < date '1998-01-01' group by all)",
    "opened_on sales_year rows item_total",
)

# ---- the page as it opens ----------------------------------------------------------------------

_FIRST = "(select * from m_opps where is_flagged order by opportunity_rank, customer_id limit 1)"
ORACLE["ranked_list_filtered"] = out(
    f"(select r.* from {_LABELLED} r join {_FIRST} f on r.salesperson = f.salesperson and r.home_branch_name = f.home_branch_name "
    "where r.priority_score >= 1000)",
    "opportunity_rank customer_id customer_name salesperson home_branch_name opportunity_type priority_score est_lost_gross_profit reason "
    "last_purchase_date days_since_last_purchase as_of_date",
)
ORACLE["customer_page_months"] = out(
    "(select d.customer_id, cast(date_trunc('month', ship_date) as date) as month, sum(d.gross_profit) as gross_profit, "
    "date_trunc('month', ship_date) = date_trunc('month', any_value(as_of)) and any_value(as_of) <> last_day(any_value(as_of)) as is_partial_month "
    f"from m_detail d join {_FIRST} f on f.customer_id = d.customer_id, m_dates where is_financial and ship_date >= p0 "
    "group by d.customer_id, date_trunc('month', ship_date))",
    "customer_id month gross_profit is_partial_month",
)
ORACLE["customer_page_invoices"] = out(
    "(select d.customer_id, ship_date, invoice_no, ship_branch_name, count(*) filter (row_source = 'product_line') as lines, sum(revenue) as sales, "
    "sum(d.gross_profit) as gross_profit, row_number() over (order by ship_date desc, invoice_no, ship_branch_name nulls last) as position "
    f"from m_detail d join {_FIRST} f on f.customer_id = d.customer_id where is_financial group by d.customer_id, ship_date, invoice_no, ship_branch_name "
    "order by position limit 15)",
    "customer_id ship_date invoice_no ship_branch_name lines sales gross_profit position",
)
ORACLE["customer_page_sheet"] = out(
    f"(select * from m_sheet where product_rank <= 10 and customer_id = (select customer_id from {_FIRST}))", "customer_id product_rank " + SHEET_COLUMNS
)
ORACLE["filter_totals"] = out(
    "(select if(grouping(salesperson) = 1, '(all)', coalesce(salesperson, '(none)')) as salesperson, "
    "if(grouping(home_branch_name) = 1, '(all)', coalesce(home_branch_name, '(none)')) as home_branch_name, "
    "if(grouping(opportunity_type) = 1, '(all)', opportunity_type) as opportunity_type, min_score, count(*) as customers, "
    "sum(est_lost_gross_profit) as est_lost_gross_profit, sum(priority_score) as expected_recoverable "
    f"from {_LABELLED}, (select unnest([0, 1000, 5000, 10000]) as min_score) where priority_score >= min_score "
    "group by min_score, cube (salesperson, home_branch_name, opportunity_type))",
    "salesperson home_branch_name opportunity_type min_score customers est_lost_gross_profit expected_recoverable",
)
ORACLE["filter_ranks"] = out(
    "(select customer_id, rank() over (partition by salesperson order by priority_score desc) as rank_in_salesperson, "
    "rank() over (partition by home_branch_name order by priority_score desc) as rank_in_home_branch_name, "
    f"rank() over (partition by opportunity_type order by priority_score desc) as rank_in_opportunity_type from {_LABELLED})",
    "customer_id rank_in_salesperson rank_in_home_branch_name rank_in_opportunity_type",
)
ORACLE["export_list"] = with_models(
    "select 1 + row_number() over (order by opportunity_rank, customer_id) as line_no, customer_id, customer_name, salesperson, home_branch_name, "
    f"reason, last_purchase_date::varchar as last_purchase_date, priority_score::decimal(18,4)::double as priority_score from {_LABELLED}"
)

# ---- many dates at once ------------------------------------------------------------------------


def _rolling(source: str, owner: str, member: str, name: str) -> str:
    return out(
        f"(with b as (select distinct {owner}, {member} as member, cast(date_trunc('month', ship_date) as date) as month from {source} "
        f"where is_purchase and {owner} is not null and {member} is not null and ship_date is not null) "
        f"select m.{owner}, m.month, count(distinct b.member) as {name} from (select distinct {owner}, month from b) m join b "
        f"on b.{owner} = m.{owner} and b.month <= m.month and b.month > m.month - interval 12 month group by m.{owner}, m.month)",
        f"{owner} month {name}",
    )


ORACLE["rolling_buyers"] = _rolling("m_lines", "product_id", "bill_to_customer_id", "buyers_12m")
ORACLE["rolling_assortment"] = _rolling("m_tx", "customer_id", "product_id", "products_12m")
ORACLE["month_end_change"] = out(
    "(with e as (select cast(last_day(f) as date) as month_end from (select unnest(generate_series((select date_trunc('month', min(ship_date)) "
    "from m_custdays), (select date_trunc('month', as_of) from m_dates), interval 1 month)) as f)), "
    "j as (select customer_id, month_end, ship_date > cast(month_end - interval 12 month as date) as recent, sales, profit from m_custdays join e "
    "on ship_date <= month_end and ship_date > cast(month_end - interval 24 month as date)) "
    "select customer_id, month_end, sum(if(recent, sales, 0)) as sales_last_12m, sum(if(recent, 0, sales)) as sales_prior_12m, "
    "sum(if(recent, profit, 0)) as gross_profit_last_12m, sum(if(recent, 0, profit)) as gross_profit_prior_12m from j group by customer_id, month_end)",
    "customer_id month_end sales_last_12m sales_prior_12m gross_profit_last_12m gross_profit_prior_12m",
)
ORACLE["early_drop_by_month"] = out(
    "(with y as (select customer_id, year(ship_date) as y, month_no, sum(if(month(ship_date) <= month_no, profit, 0)) as so_far, sum(profit) as whole "
    "from m_custdays, (select unnest(range(1, 13)) as month_no) group by all), "
    "p as (select b.month_no, coalesce(n.so_far, 0) as s, b.so_far as sb, coalesce(n.whole, 0) as f, b.whole as fb from y b "
    "left join y n on n.customer_id = b.customer_id and n.y = b.y + 1 and n.month_no = b.month_no cross join m_dates "
    "where b.y + 1 < year(as_of) and b.so_far >= 2000 and b.customer_id in (select customer_id from m_custdays where bought)), "
    "d as (select *, 1.0::double - s::decimal(18,4)::double / sb::decimal(18,4)::double as dr from p) "
    "select month_no, case when dr >= 0.40::double then 'down 40%+' when dr >= 0.20::double then 'down 20-40%' when dr >= 0.15::double then 'down 15-20%' "
    "when dr >= 0.10::double then 'down 10-15%' when dr > 0 then 'down 0-10%' else 'up or flat' end as band, count(*) as cases, "
    "count(*) filter (f < fb) as ended_down, count(*) filter (f * 10 <= fb * 9) as ended_down_10 from d group by 1, 2)",
    "month_no band cases ended_down ended_down_10",
)
ORACLE["rhythm_states"] = out(
    "(with d as (select customer_id, ship_date from m_custdays where bought and ship_date is not null), "
    "s as (select customer_id, min(ship_date) as a, max(ship_date) as z, count(*) as n from d group by 1), "
    "g as (select customer_id, date_diff('day', lag(ship_date) over (partition by customer_id order by ship_date), ship_date) as gap from d), "
    "u as (select *, date_diff('day', a, z)::double / nullif(n - 1, 0) as usual from s) "
    "select u.customer_id, any_value(a) as first_purchase_date, any_value(z) as last_purchase_date, any_value(n) as purchase_day_count, "
    "any_value(usual) as avg_days_between_purchases, max(gap) as longest_gap, count(*) filter (gap > 2 * usual) as gaps_over_2x, "
    "count(*) filter (gap > 4 * usual) as gaps_over_4x from u join g using (customer_id) group by u.customer_id)",
    "customer_id first_purchase_date last_purchase_date purchase_day_count avg_days_between_purchases longest_gap gaps_over_2x gaps_over_4x",
)
ORACLE["dq_gate"] = " union all ".join(
    'select *, case when failing_rows = 0 then \'pass\' when severity = \'error\' then \'stop\' else \'warn\' end as action '
    f"from ({ORACLE[name]})" for name in ("dq_unique", "dq_not_null", "dq_accepted_values", "dq_relationships")
)
