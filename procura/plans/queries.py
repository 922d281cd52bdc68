"""Parameterised report queries (Q1..Q10) and browse helpers.

Parameters are plain function arguments.  Look-ups resolve the ids of the
matching parents first and build the marts over those parents only
(:mod:`procura.sources.subset`); nesting comes last.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.operators.nesting import to_json_text
from procura.plans.marts import ORDER, Marts
from procura.plans.reports import NO_SHOWN_ORDER, VIEW_ORDER, Reports
from procura.sources.commits import MONTH_COLUMN
from procura.sources.sinks import register_views as sink_views
from procura.sources.sinks import sort_key
from procura.sources.subset import SubsetSources, children_of, keep, only_invoices, renewed

# Browse limits of the reporting front end.
MAX_RETURNED_ROWS = 10_000


def _json_arrays(df: DataFrame) -> DataFrame:
    """Nested array columns as JSON text (null fields kept) for display."""
    return df.select(*[to_json_text(f.name).alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name)
                       for f in df.schema.fields])


def _over(m: Marts, src) -> Marts:
    return Marts(src, chunk_size=m.chunk_size, materialize=m.materialize_mode)


def invoices_for_order(m: Marts, order_record_num: int) -> DataFrame:
    """Q1: invoices that pay for an order (by order record number), the last
    updated first."""
    order = m.record_nums(ORDER, "_oid", "_num").filter(F.col("_num") == order_record_num).select("_oid").distinct()
    lines = m.src.invoice_record_line
    # the ids of one record number are few
    ids = (lines.join(F.broadcast(order), lines.order_record_metadata_id == order._oid, "left_semi")
           .select("invoice_record_id"))
    found = _over(m, only_invoices(m.src, ids, few=True)).invoice
    return _json_arrays(found.orderBy(F.col("last_updated").desc_nulls_last(), "invoice_record_num"))


def on_order_by_fund(m: Marts, fund_code: str) -> DataFrame:
    """Q2: on-order orders with a fund child of ``fund_code``; an order is
    repeated once per matching child (unnest + filter, not EXISTS)."""
    on_order = m.src.order_record.filter(F.col("order_status_code") == "o")
    kids = m.order_funds_frame(fund_code).select("order_record_id")
    # the orders of the fund meet those on order, not their children one by one
    ids = kids.distinct().join(on_order.select(F.col("record_id").alias("order_record_id")), "order_record_id", "left_semi")
    found = SubsetSources(m.src, order_record=renewed(on_order), order_record_cmf=children_of(m.src, ids))
    return _json_arrays(_over(m, found).orders.join(kids, "order_record_id"))


def multi_fund_orders(m: Marts, more_than: int, order_status_code: str) -> DataFrame:
    """Q3: orders using more than ``more_than`` distinct fund codes, by
    creation date."""
    chosen = m.src.order_record.filter(F.col("order_status_code") == order_status_code)
    kids = SubsetSources(m.src, order_record_cmf=children_of(m.src, chosen.select("record_id")))
    ids = (_over(m, kids).order_funds_flat.groupBy("order_record_id")
           .agg(F.count_distinct("_raw_fund_code").alias("n")).filter(F.col("n") > more_than).select("order_record_id"))
    o = _over(m, SubsetSources(m.src, order_record=renewed(chosen), order_record_cmf=children_of(m.src, ids))).orders
    return _multi_fund_listing(o)


def _multi_fund_listing(orders: DataFrame) -> DataFrame:
    return _json_arrays(orders.select(
        "order_record_num", F.to_date("creation_date_gmt").alias("creation_date"), "count_cmf",
        F.col("count_distinct_cmf_fund_codes").alias("count_fund_codes"), "sum_cmf_copies", "cmf_data",
        "bib_record_id", F.col("accounting_unit_code_num").alias("accnt_unit_code"),
        (F.col("estimated_price_cents").cast("decimal(14,0)") / 100).cast("decimal(14,2)").alias("estimated_price"),
        "physical_form_name", F.to_date("order_date_gmt").alias("order_date"),
        F.to_date("catalog_date_gmt").alias("cat_date"), "order_type_name", "order_status_code",
        "order_status_name", "vendor_record_code", "vendor_record_id", "volume_count")
        .orderBy(F.col("creation_date").asc_nulls_first(), "order_record_num"))


class PublishedQueries:
    """The look-ups and the browse of the front end over published tables
    (``table(name)`` gives one): what they need is read, nothing is built.

    Q1 to Q3 find their rows by a Bloom filter or a sorted column of a small
    flat table and meet the nested mart by record id.  Q9 reads the counts per
    value of the leading sort column first: they tell up to which value the
    first rows go, and the ledger's files and row groups beyond are skipped."""

    def __init__(self, table: Callable[[str], DataFrame]):
        self.table = table

    def invoices_for_order(self, order_record_num: int) -> DataFrame:
        """Q1."""
        ids = (self.table("invoice_record_order_record_link").filter(F.col("order_record_num") == order_record_num)
               .select("invoice_record_id"))
        found = keep(self.table("invoice"), "invoice_record_id", ids, few=True)
        return _json_arrays(found.orderBy(F.col("last_updated").desc_nulls_last(), "invoice_record_num"))

    def on_order_by_fund(self, fund_code: str) -> DataFrame:
        """Q2: an order once per matching child."""
        kids = self.table("order_funds_flat").filter(F.col("fund_code") == fund_code).select("order_record_id")
        orders = self.table("orders").filter(F.col("order_status_code") == "o")
        return _json_arrays(orders.join(kids, "order_record_id").select(*orders.columns))

    def multi_fund_orders(self, more_than: int, order_status_code: str) -> DataFrame:
        """Q3."""
        return _multi_fund_listing(self.table("orders").filter(
            (F.col("order_status_code") == order_status_code) & (F.col("count_distinct_cmf_fund_codes") > more_than)))

    def first_ledger_rows(self, n: int = MAX_RETURNED_ROWS) -> DataFrame:
        """Q9: the first ``n`` rows of the second ledger format in its order."""
        order = [sort_key(*key) for key in VIEW_ORDER["ledger_lines_alt_view"]]
        lead, counts = VIEW_ORDER["ledger_lines_alt_view"][0][0], self.table("ledger_lines_alt_counts")
        # every value has a row, so the first n values reach n rows: at most n rows here
        left, last = n, None
        for value, count in counts.orderBy(F.col(lead).asc_nulls_first()).limit(n).collect():
            left, last = left - count, value
            if left <= 0:
                break
        df = self.table("ledger_lines_alt_view").drop(MONTH_COLUMN)
        if left <= 0:
            df = df.filter(F.col(lead).isNull() if last is None else F.col(lead).isNull() | (F.col(lead) <= last))
        return top_rows(df, order, n)

    def ledger_facet(self) -> DataFrame:
        """Q10 on the payee: the counts as published."""
        return facet_of(self.table("ledger_lines_alt_counts"), "pe_id")

    def ledger_lines_between(self, posted_from: str, posted_to: str, hide: list[str] | None = None) -> DataFrame:
        """Q7 over the second ledger format: the files of the months in range."""
        return browse(self.table("ledger_lines_alt_view"), {"posted_date": posted_from}, {"posted_date": posted_to},
                      [MONTH_COLUMN, *(hide or [])])


def order_status_counts(m: Marts) -> DataFrame:
    """Q4: number of orders per status, the most frequent first."""
    return (m.order_header.groupBy("order_status_code", "order_status_name")
            .agg(F.count(F.lit(1)).cast("bigint").alias("count"))
            .orderBy(F.col("count").desc(), "order_status_code"))


def _order_listing(o: DataFrame, with_total: bool) -> DataFrame:
    price = (F.col("estimated_price_cents").cast("decimal(14,0)") / 100).cast("decimal(14,2)")
    total = ((F.col("estimated_price_cents") * F.col("sum_cmf_copies")).cast("decimal(20,0)") / 100) \
        .cast("decimal(20,2)")
    if with_total:
        head = ["order_record_num", "count_cmf", "sum_cmf_copies", "bib_record_num",
                F.to_date("creation_date_gmt").alias("create_date"), price.alias("est_price"),
                total.alias("est_total_price")]
    else:
        head = ["order_record_num", "orders_display_order", "count_cmf", "sum_cmf_copies", "bib_record_id",
                F.to_date("creation_date_gmt").alias("create_date"), price.alias("est_price")]
    tail = ["physical_form_name", F.to_date("order_date_gmt").alias("order_date"),
            F.to_date("catalog_date_gmt").alias("cat_date"), F.col("order_type_name").alias("order_type"),
            F.to_date("received_date_gmt").alias("received_date"), "order_status_name", "volume_count"]
    return o.select(*head, *tail)


def on_order_list(m: Marts) -> DataFrame:
    """Q5: on-order listing with derived price and dates, by order number."""
    return _order_listing(m.order_header.filter(F.col("order_status_code") == "o"),
                          with_total=False).orderBy("order_record_num")


def order_price_list(m: Marts) -> DataFrame:
    """Q6: order listing with estimated total price = price x copies."""
    return _order_listing(m.order_header, with_total=True)


def browse(df: DataFrame, gte: dict | None = None, lte: dict | None = None,
           hide: list[str] | None = None) -> DataFrame:
    """Q7: range filters ``col >= a`` / ``col <= b`` and hidden columns, the
    way a report is browsed with URL filters.  Filters are plain predicates,
    so they reach the parquet scan when the report is read from storage; a
    range of posting dates also prunes the months a table is partitioned by."""
    for bounds, keeps in ((gte, Column.__ge__), (lte, Column.__le__)):
        for c, v in (bounds or {}).items():
            df = df.filter(keeps(F.col(c), F.lit(v)))
            if c == "posted_date" and MONTH_COLUMN in df.columns:
                df = df.filter(keeps(F.col(MONTH_COLUMN), F.lit(str(v)[:7])))
    return df.drop(*(hide or []))


def in_order(df: DataFrame, view: str) -> DataFrame:
    """A mart or report in the order in which it is shown (a range sort); one
    that is shown in no particular order is returned as it is."""
    if view not in VIEW_ORDER:
        if view not in NO_SHOWN_ORDER:
            raise ValueError(f"no mart or report is called {view!r}; there are {', '.join(sorted({*VIEW_ORDER, *NO_SHOWN_ORDER}))}")
        return df
    return df.orderBy(*[sort_key(*key) for key in VIEW_ORDER[view]])


def ledger_lines_between(m: Marts, posted_from: str, posted_to: str, hide: list[str] | None = None) -> DataFrame:
    """Q7 over the second ledger format computed from the sources: the range
    of posting dates picks the invoices before their lines are allocated."""
    end = dt.date.fromisoformat(posted_to) + dt.timedelta(days=1)
    posted = m.src.invoice_record.filter(
        (F.col("posted_data_gmt") >= F.lit(posted_from).cast("timestamp_ntz"))
        & (F.col("posted_data_gmt") < F.lit(str(end)).cast("timestamp_ntz")))
    chosen = only_invoices(m.src, posted.select("record_id"))
    chosen = SubsetSources(chosen, invoice_record=posted)
    return Reports(_over(m, chosen)).ledger_lines_alt_view.drop(*(hide or []))


def barcode_search(m: Marts, pattern: str) -> DataFrame:
    """Q8: items whose barcode field matches a LIKE pattern."""
    items = m.record_nums("i", "item_record_id", "item_record_num")
    b = (m.src.varfield.filter((F.col("varfield_type_code") == "b") & F.col("field_content").like(pattern))
         .select(F.col("record_id").alias("item_record_id"), F.col("field_content").alias("barcode")))
    return b.join(items, "item_record_id").select("item_record_id", "item_record_num", "barcode")


def top_rows(df: DataFrame, order: list[Column], n: int = MAX_RETURNED_ROWS) -> DataFrame:
    """Q9: the first ``n`` rows of a sorted report (a top-k: each task keeps
    its best ``n`` rows, only those are merged)."""
    return df.orderBy(*order).limit(n)


def facet_counts(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """Q10: the values of a column with their counts (largest first, ties by
    value); the ``n`` most frequent ones if ``n`` is given, else all."""
    return facet_of(df.groupBy(col).agg(F.count(F.lit(1)).cast("bigint").alias("count")), col, n)


def facet_of(counts: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """Q10 from counts per value."""
    out = counts.select(F.col(col).alias("value"), "count").orderBy(F.col("count").desc(), F.col("value").asc_nulls_last())
    return out if n is None else out.limit(n)


def register_views(spark: SparkSession, m: Marts, r: Reports) -> list[str]:
    """Register marts and reports as temporary views for SQL access."""
    views = {
        "varfield_metadata": m.varfield_metadata, "varfield": m.varfield, "fund": m.fund,
        "invoice": m.invoice, "invoice_line_data": m.invoice_line_data,
        "invoice_record_order_record_link": m.invoice_record_order_record_link,
        "invoice_record_vendor_record_link": m.invoice_record_vendor_record_link,
        "orders": m.orders, "order_header": m.order_header, "order_funds_flat": m.order_funds_flat,
        "vendors": m.vendors, "vendor_header": m.vendor_header,
        "invoice_record_vendor_summary": m.invoice_record_vendor_summary,
        "order_record_received": m.order_record_received,
        "on_order_view": r.on_order_view, "vendors_summary_view": r.vendors_summary_view,
        "vendors_summary_last_invoice_view": r.vendors_summary_last_invoice_view,
        "fiscal_office_vendors_view": r.fiscal_office_vendors_view,
        "invoice_export_rows": r.invoice_export_rows, "peid_view": r.peid_view, "ref_view": r.ref_view,
        "ledger_export_table": r.ledger_export_table, "ledger_export_view": r.ledger_export_view,
        "ledger_lines_alt_view": r.ledger_lines_alt_view,
        "invoice_vendor_alt_code_view": r.invoice_vendor_alt_code_view,
        "fully_paid_order_bib_avg_item_cost_view": r.fully_paid_order_bib_avg_item_cost_view,
        "fund_use": r.fund_use,
    }
    return sink_views(views)


#: The queries of the reporting front end by name; ``run_canned`` runs them.
CANNED = {"invoice_with_order": (invoices_for_order, "order_record_num"),
          "on_order_fund_code": (on_order_by_fund, "fund_code")}


def run_canned(m: Marts, name: str, **params) -> DataFrame:
    """Run a canned query with its named parameter."""
    query, parameter = CANNED[name]
    return query(m, params[parameter])
