"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each callable derives the source relations from the test tables under
``sf_dir`` and runs one mart, report or report query over the whole tables.
Nested array columns are rendered as JSON text (null fields kept) so results
compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.operators.nesting import unnest
from procura.plans import queries as Q
from procura.plans import roundtrip as T
from procura.plans.marts import Marts
from procura.plans.reports import VIEW_ORDER, Reports
from procura.session import apply_sql_conf
from procura.sources.testdata import TestSources

# Fixed parameter values of the registered report queries.
PARAMS = {
    "order_record_num": 1_000_100,
    "fund_code": "brd13",
    "more_than_funds": 2,
    "order_status_code": "o",
    "posted_from": "1997-01-01",
    "posted_to": "1997-12-31",
    "barcode_pattern": "%77%",
}


def marts_for(spark: SparkSession, sf_dir: str) -> Marts:
    """Marts as one lazy plan: nothing is cached or run before an action."""
    apply_sql_conf(spark)
    return Marts(TestSources(spark, sf_dir), materialize="none")


def reports_for(spark: SparkSession, sf_dir: str) -> Reports:
    return Reports(marts_for(spark, sf_dir))


def _m(fn: Callable[[Marts], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(marts_for(spark, sf_dir))
    run.on_marts = fn  # the same query over any sources (stored tables, JDBC)
    return run


def _r(fn: Callable[[Reports], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(reports_for(spark, sf_dir))
    run.on_marts = lambda m: fn(Reports(m))
    return run


J = Q._json_arrays

ALT_ORDER = [c for c, _ in VIEW_ORDER["ledger_lines_alt_view"]]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # marts
    "varfield_types": _m(lambda m: m.varfield_metadata),
    "varfield_rows": _m(lambda m: m.varfield),
    "fund_balances": _m(lambda m: m.fund),
    "fund_balances_inner": _m(lambda m: m.fund_frame("inner")),
    "fund_by_code": _m(lambda m: m.fund_by_code()),
    "invoice_nested": _m(lambda m: J(m.invoice)),
    "invoice_nested_inner": _m(lambda m: J(m.invoice_frame("inner", allocation=False))),
    "invoice_line_allocation": _m(lambda m: m.invoice_line_data),
    "invoice_order_link": _m(lambda m: m.invoice_record_order_record_link),
    "invoice_vendor_link": _m(lambda m: m.invoice_record_vendor_record_link),
    "order_summary": _m(lambda m: J(m.orders)),
    "vendor_nested": _m(lambda m: J(m.vendors)),
    "vendor_summary_rows": _m(lambda m: m.invoice_record_vendor_summary),
    "receipts": _m(lambda m: m.order_record_received),
    # report views
    "on_order": _r(lambda r: r.on_order_view),
    "vendor_activity": _r(lambda r: r.vendors_summary_view),
    "vendor_last_invoice": _r(lambda r: r.vendors_summary_last_invoice_view),
    "fiscal_vendor_match": _r(lambda r: r.fiscal_office_vendors_view),
    "invoice_unnested": _r(lambda r: r.invoice_export_rows),
    "payee_id": _r(lambda r: r.peid_view),
    "invoice_reference": _r(lambda r: r.ref_view),
    "ledger_export": _r(lambda r: r.ledger_export_table),
    "ledger_export_distinct": _r(lambda r: r.ledger_export_view),
    "ledger_lines_alt": _r(lambda r: r.ledger_lines_alt_view),
    "vendor_alt_code": _r(lambda r: r.invoice_vendor_alt_code_view),
    "fully_paid_cost": _r(lambda r: J(r.fully_paid_order_bib_avg_item_cost_view)),
    "fund_use_long": _r(lambda r: r.fund_use),
    # report queries
    "invoices_for_order": _m(lambda m: Q.invoices_for_order(m, PARAMS["order_record_num"])),
    "on_order_by_fund": _m(lambda m: Q.on_order_by_fund(m, PARAMS["fund_code"])),
    "multi_fund_orders": _m(lambda m: Q.multi_fund_orders(m, PARAMS["more_than_funds"],
                                                          PARAMS["order_status_code"])),
    "order_status_counts": _m(Q.order_status_counts),
    "on_order_list": _m(Q.on_order_list),
    "order_price_list": _m(Q.order_price_list),
    "report_range": _m(lambda m: Q.ledger_lines_between(m, PARAMS["posted_from"], PARAMS["posted_to"],
                                                        hide=["extra_data", "alt_addr_cd"])),
    "barcode_search": _m(lambda m: Q.barcode_search(m, PARAMS["barcode_pattern"])),
    # sorted as the reference's view (ascending, nulls first as its engine
    # sorts them), with total tie-breakers after its three sort columns
    "report_top": _r(lambda r: Q.top_rows(r.ledger_lines_alt_view,
                                          [F.col(c).asc_nulls_first() for c in ALT_ORDER])),
    # the nested lines unnested again
    "invoice_lines_from_nested": _m(lambda m: unnest(m.invoice.select("invoice_record_id", "json_invoice_record_line"),
                                                     "json_invoice_record_line")),
    "facet_counts": _r(lambda r: Q.facet_of(r.ledger_lines_alt_counts, "pe_id")),
    # round trips through the sinks and sources
    "fiscal_funds_file": _m(T.fiscal_funds_file),
    "fiscal_vendors_file": _m(T.fiscal_vendors_file),
    "stored_sources_fund": _m(T.stored_sources_fund),
    "typed_vendors_table": _m(T.typed_vendors_table),
    "stored_fund_use": _r(T.stored_fund_use),
    "ledger_alt_file": _r(T.ledger_alt_file),
    "published_receipts": _m(T.published_receipts),
    "fund_use_view": _r(T.fund_use_view),
    # the ledgers over bucketed tables
    "ledger_export_bucketed": _r(T.bucketed(lambda r: r.ledger_export_table)),
    "ledger_export_distinct_bucketed": _r(T.bucketed(lambda r: r.ledger_export_view)),
    "ledger_lines_alt_bucketed": _r(T.bucketed(lambda r: r.ledger_lines_alt_view)),
    # look-ups and browsing over published tables
    "invoices_for_order_published": _m(T.published("invoice_record_order_record_link", "invoice")(
        lambda q: q.invoices_for_order(PARAMS["order_record_num"]))),
    "on_order_by_fund_published": _m(T.published("order_funds_flat", "orders")(
        lambda q: q.on_order_by_fund(PARAMS["fund_code"]))),
    "multi_fund_orders_published": _m(T.published("orders")(
        lambda q: q.multi_fund_orders(PARAMS["more_than_funds"], PARAMS["order_status_code"]))),
    "report_top_published": _r(T.published_ledger(lambda q: q.first_ledger_rows())),
    "report_range_published": _r(T.published_ledger(lambda q: q.ledger_lines_between(
        PARAMS["posted_from"], PARAMS["posted_to"], hide=["extra_data", "alt_addr_cd"]))),
    "facet_counts_published": _r(T.published_ledger(lambda q: q.ledger_facet())),
}

#: Registered queries that write while they are built.
ROUND_TRIPS = ("fiscal_funds_file", "fiscal_vendors_file", "stored_sources_fund", "typed_vendors_table",
               "stored_fund_use", "ledger_alt_file", "published_receipts", "fund_use_view",
               *(n for n in QUERIES if n.endswith(("_bucketed", "_published"))))
