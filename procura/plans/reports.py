"""Report views (V1..V13) over the marts.

Each report is a lazy DataFrame.  Reports that unnest invoice lines read the
flat line form of the invoice mart (:attr:`Marts.invoice_lines_flat`), which
gives the same rows as unnesting the nested array without routing a whole
invoice through one row.  The reports themselves are order-free relations;
``VIEW_ORDER`` has the order in which each is shown, which
:func:`procura.plans.queries.in_order` and the file writers apply (a range
sort, never one partition).

Column names of the two ledger exports are snake_case here; the export
headers of the fiscal system are in ``LEDGER_HEADERS`` / ``ALT_LEDGER_HEADERS``
and are applied by the CSV writer.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from procura.functions import (cents_to_money, gl_object_description, int_prefix, pct_of,
                               strip_zeros_if_numeric)
from procura.operators.nesting import first_by, in_runs, nest
from procura.operators.reshape import concat_distinct, fallback_lookup, melt, with_headings
from procura.operators.sizing import join_clustered, join_null_safe
from procura.plans.marts import VENDOR, Marts

# Export headers of the ledger export, in column order.
LEDGER_HEADERS = {
    "row_type": "HDR ROW TYPE / DTL ROW TYPE",
    "vendor_number": "HDR VENDOR NUMBER / DTL VENDOR NUMBER",
    "invoice_number": "HDR INVOICE NUMBER / DTL INVOICE NUMBER",
    "invoice_total_or_sequence": "HDR INVOICE TOTAL / DTL SEQUENCE",
    "net_amount": "HDR INVOICE NET AMOUNT / DTL AMOUNT",
    "payment_method_or_description": "HDR PAYMENT METHOD / DTL DESCRIPTION",
    "invoice_date_or_org": "HDR INVOICE DATE/DTL ORG",
    "due_date_or_object": "HDR DUE DATE/DTL OBJECT",
    "extra_data": "_extra_data -->",
}
# Export headers of the second ledger format.
ALT_LEDGER_HEADERS = {
    "pe_id": "PeId", "ref": "Ref", "div": "Div", "dist_amt": "DistAmt", "check_id": "CheckId",
    "ref_dt": "RefDt", "gl_key": "GLKey", "gl_obj": "GLObj", "alt_addr_cd": "AltAddrCd",
    "extra_data": "_extra_data -->", "orig_dist_amt": "OrigDistAmt",
}
# Constants of the second ledger format.
ALT_LEDGER_DIVISION = "GEN"
ALT_LEDGER_CHECK_ID = "AP"
ALT_LEDGER_ADDRESS_CODE = "B1"
# Labels of the fund-use chart series.
FUND_USE_SERIES = {"expenditure": " expenditure % used", "encumbrance": "encumbrance % used"}

# Order of each report as shown: (column, direction), then unique tie-breakers.
VIEW_ORDER = {
    "fund": (("fund_master_id", "asc"), ("fund_type", "asc"), ("fund_code", "asc")),
    "varfield_metadata": (("record_type_name", "asc nulls last"), ("varfield_display_order", "asc nulls last"),
                          ("record_type_code", "asc"), ("varfield_code", "asc")),
    "invoice_record_order_record_link": (("invoice_record_id", "asc"), ("order_record_id", "asc")),
    "vendors": (("vendor_record_id", "asc"),),
    "invoice_record_vendor_summary": (("invoice_record_vendor_summary_id", "desc"),),
    "vendors_summary_last_invoice_view": (("last_order_date", "desc"), ("vendor_record_num", "asc")),
    "vendors_summary_view": (("last_order_date", "desc"), ("vendor_record_num", "asc")),
    "fiscal_office_vendors_view": (("FiscalVendorId", "asc"), ("FiscalVendorCode", "asc")),
    "invoice_export_rows": (("invoice_date", "asc"), ("invoice_number_text", "asc"), ("line_cnt", "asc"),
                            ("invoice_record_id", "asc")),
    "ledger_export_table": (("invoice_date", "asc"), ("invoice_record_id", "asc"), ("row_type", "desc"),
                            ("invoice_total_or_sequence", "asc")),
    "ledger_export_view": (("invoice_date", "asc"), ("invoice_record_id", "asc"), ("row_type", "desc"),
                           ("invoice_total_or_sequence", "asc")),
    "ledger_lines_alt_view": (("pe_id", "asc"), ("ref", "asc"), ("line_cnt", "asc"), ("invoice_record_id", "asc"),
                              ("gl_key", "asc"), ("gl_obj", "asc"), ("dist_amt", "asc"), ("fund_code", "asc"),
                              ("vendor_code", "asc")),
    "invoice_vendor_alt_code_view": (("count_invoices", "desc"), ("vendor_code", "asc"), ("alternate_code", "asc")),
}

#: Marts and reports that are shown in no particular order.
NO_SHOWN_ORDER = ("varfield", "invoice", "invoice_header", "invoice_lines_flat", "invoice_line_data",
                  "invoice_record_vendor_record_link", "orders", "order_header", "order_funds_flat", "vendor_header",
                  "order_record_received", "on_order_view", "peid_view", "ref_view",
                  "fully_paid_order_bib_avg_item_cost_view", "fund_use")

US_DATE = "MM/dd/yyyy"


def _money(col) -> F.Column:
    return cents_to_money(col, 14)


class Reports:
    def __init__(self, marts: Marts):
        self.m = marts
        self.src = marts.src

    # ------------------------------------------------------------ V1 on order
    @cached_property
    def on_order_view(self) -> DataFrame:
        o = self.m.order_header.filter(F.col("order_status_code") == "o")
        # fund codes per order from the flat children; the header is joined once
        funds = (self.m.order_funds_flat.filter(F.col("fund_code").isNotNull())
                 .groupBy("order_record_id").agg(concat_distinct("fund_code").alias("fund_codes")))
        return o.join(funds, "order_record_id").select(
            "order_record_num", "fund_codes", "count_cmf", "sum_cmf_copies", "bib_record_num",
            F.to_date("creation_date_gmt").alias("create_date"),
            _money("estimated_price_cents").alias("est_price"),
            cents_to_money(F.col("estimated_price_cents") * F.col("sum_cmf_copies"), 20).alias("est_total_price"),
            "physical_form_name", F.to_date("order_date_gmt").alias("order_date"),
            F.to_date("catalog_date_gmt").alias("cat_date"), F.col("order_type_name").alias("order_type"),
            F.to_date("received_date_gmt").alias("received_date"), "order_status_name",
            "vendor_record_code", "volume_count")

    # -------------------------------------------------------- V2 / V3 vendors
    @cached_property
    def _vendor_orders(self) -> DataFrame:
        """Per vendor: number of orders and latest order time.  Aggregated
        before the join, so one vendor with a huge share of the orders is
        pre-aggregated map side instead of fanning out through a join."""
        return (self.m.order_header.filter(F.col("vendor_record_id").isNotNull())
                .groupBy("vendor_record_id")
                .agg(F.max("order_date_gmt").alias("max_order_date_gmt"),
                     F.count("order_record_num").alias("n_orders")))

    def _vendor_summary(self) -> DataFrame:
        v = self.m.vendor_header
        a = self._vendor_orders
        return (v.join(a, "vendor_record_id", "left")
                .select("vendor_record_id", "vendor_record_num", "vendor_record_code", "vendor_name",
                        F.coalesce("n_orders", F.lit(0)).cast("bigint").alias("count_total_order_records"),
                        F.to_date("max_order_date_gmt").alias("last_order_date"),
                        F.col("record_create_date").alias("vendor_record_create_date"),
                        F.col("record_last_updated").alias("vendor_record_last_updated")))

    @cached_property
    def vendors_summary_view(self) -> DataFrame:
        return self._vendor_summary().drop("vendor_record_id")

    @cached_property
    def vendors_summary_last_invoice_view(self) -> DataFrame:
        paid = (self.m.invoice_record_vendor_record_link.select("invoice_record_id", "vendor_record_id")
                .filter(F.col("vendor_record_id").isNotNull())
                .join(self.m.invoice_header.select("invoice_record_id", "paid_date"), "invoice_record_id")
                .groupBy("vendor_record_id").agg(F.max("paid_date").alias("last_invoice_paid_date")))
        s = self._vendor_summary()
        return (s.join(paid, "vendor_record_id", "left")
                .select("vendor_record_num", "vendor_record_code", "vendor_name", "count_total_order_records",
                        "last_order_date", "last_invoice_paid_date", "vendor_record_create_date",
                        "vendor_record_last_updated"))

    # ------------------------------------------------- V4 fiscal vendor match
    @cached_property
    def fiscal_office_vendors_view(self) -> DataFrame:
        f = self.src.fiscal_vendors
        v = self.m.vendor_header.select("vendor_record_code", "vendor_record_num", "vendor_record_id",
                                  "record_create_date", "record_last_updated")
        last = self._vendor_orders.select("vendor_record_id",
                                          F.to_date("max_order_date_gmt").alias("max_order_date"))
        return (f.join(v, v.vendor_record_code == f.IlsVendorCode, "left")
                .join(last, "vendor_record_id", "left")
                .select("FiscalVendorId", "FiscalVendorCode", "VendorName", "IlsVendorCode",
                        "vendor_record_num", "vendor_record_id", "record_create_date", "record_last_updated",
                        "max_order_date"))

    # ------------------------------------------------------ invoice line rows
    @cached_property
    def invoice_line_rows(self) -> DataFrame:
        """Unnested invoice lines joined to their invoice header."""
        h = self.m.invoice_header
        return self.m.invoice_line_base.join(h, "invoice_record_id")

    @cached_property
    def _vendor_pairs(self) -> DataFrame:
        """Lines per (invoice, vendor code as written); an invoice without
        lines has one pair with a null code and no line."""
        return (self.m.invoice_line_base.groupBy("invoice_record_id", "vendor_code")
                .agg(F.count("_line").cast("bigint").alias("n_lines")))

    # ------------------------------------------------ V5 invoice export rows
    @cached_property
    def invoice_export_rows(self) -> DataFrame:
        rows = self.invoice_line_rows
        keys = ["invoice_record_id", "invoice_record_num", "invoice_number_text", "posted_date", "invoice_date"]
        detail = rows.select(*keys, (F.col("line_cnt") + 1).alias("line_cnt"),
                             _money("paid_amt_cents").alias("paid_amount"), "vendor_code",
                             F.lit(None).cast("decimal(14,2)").alias("discount_amt"),
                             F.lit(None).cast("decimal(14,2)").alias("grand_total_amt"),
                             F.lit(None).cast("decimal(14,2)").alias("subtotal_amt"))
        # one heading per (invoice, vendor code): reduce the lines to those
        # pairs first, then attach the header at that grain
        heading = (self._vendor_pairs.join(self.m.invoice_header, "invoice_record_id")
                   .select(*keys, F.lit(None).cast("int").alias("line_cnt"),
                           F.lit(None).cast("decimal(14,2)").alias("paid_amount"), "vendor_code",
                           _money("discount_amt_cents").alias("discount_amt"),
                           _money("grand_total_amt_cents").alias("grand_total_amt"),
                           _money("subtotal_amt_cents").alias("subtotal_amt")))
        return with_headings(detail, heading)

    # ------------------------------------------------------------ V6 payee id
    @cached_property
    def _alternate_codes(self) -> DataFrame:
        """Per vendor code the vendor's lowest-occurrence alternate code ('d'
        field).  'z' fields never give a payee (the reference sorts them after
        'd' and blanks them)."""
        v = self.m.vendor_header.select("vendor_record_id", "vendor_record_code")
        # the fields' records are vendors, as they are joined to them: no other record is read
        fields = self.m.varfield.filter((F.col("varfield_type_code") == "d") & (F.col("record_type_code") == VENDOR))
        return (fields.select(F.col("record_id").alias("vendor_record_id"), "occ_num", "varfield_id", "field_content")
                .join(v, "vendor_record_id")
                .groupBy(F.col("vendor_record_code").alias("k"))
                .agg(first_by("field_content", ["occ_num", "varfield_id"]).alias("v")))

    @cached_property
    def _fiscal_codes(self) -> DataFrame:
        """Per vendor code the fiscal office's code of the lowest id."""
        return (self.src.fiscal_vendors.groupBy(F.col("IlsVendorCode").alias("k"))
                .agg(first_by("FiscalVendorCode", ["FiscalVendorId", "FiscalVendorCode"]).alias("v")))

    def _with_payee(self, df: DataFrame, code_col: str, out: str) -> DataFrame:
        """Payee id: the alternate code, else the fiscal office's code."""
        return fallback_lookup(df, F.trim(F.col(code_col)), self._alternate_codes, self._fiscal_codes, out)

    @cached_property
    def peid_view(self) -> DataFrame:
        # distinct (invoice, vendor code) first: the look-up then runs once per
        # invoice and vendor instead of once per line
        pairs = (self._vendor_pairs
                 .join(self.m.invoice_header.select("invoice_record_id", "invoice_record_num",
                                                    "invoice_number_text"), "invoice_record_id"))
        return (self._with_payee(pairs, "vendor_code", "peid")
                .select("invoice_record_id", "invoice_record_num", "invoice_number_text", "peid").distinct())

    # ------------------------------------------------------- V7 reference
    @cached_property
    def ref_view(self) -> DataFrame:
        return self.m.invoice_header.select(
            "invoice_record_id", F.col("invoice_number_text").alias("invoice_number_text_orig"),
            strip_zeros_if_numeric("invoice_number_text").alias("ref"))

    # ---------------------------------------------------- V8 / V9 ledger export
    @cached_property
    def _line_counts(self) -> DataFrame:
        """Number of lines per invoice (0 for an invoice without lines)."""
        return (self.m.invoice_line_base.groupBy("invoice_record_id")
                .agg(F.count("_line").cast("bigint").alias("count_invoice_record_line")))

    @cached_property
    def invoice_data(self) -> DataFrame:
        """Invoice header with line count, one payee id and the reference.
        Lines are grouped by (invoice, vendor code) once, for both figures."""
        per_invoice = (self._with_payee(self._vendor_pairs, "vendor_code", "peid").groupBy("invoice_record_id")
                       .agg(F.sum("n_lines").alias("count_invoice_record_line"),
                            first_by("peid", ["peid"]).alias("peid")))
        return self.m.invoice_header.join(per_invoice, "invoice_record_id").withColumn(
            "ref", strip_zeros_if_numeric("invoice_number_text")).select(*self.INVOICE_DATA)

    #: Columns of :attr:`invoice_data`, as the ledger export shows them.
    INVOICE_DATA = ("invoice_record_id", "invoice_record_num", "invoice_number_text", "count_invoice_record_line",
                    "invoice_date", "paid_date", "invoice_record_status_code", "posted_date", "grand_total_amt_cents",
                    "subtotal_amt_cents", "peid", "ref")

    @cached_property
    def current_funds(self) -> DataFrame:
        """Current-year funds ('fbal') with their general-ledger mapping."""
        f = self.m.fund.filter(F.col("fund_type") == "fbal").select(
            "fund_code_num", F.col("fund_code").alias("fund_table_code"))
        fo = self.src.fiscal_funds.select(F.lower("IlsFundCode").alias("_glcode"), "GLKey", "GLObj")
        return f.join(fo, F.lower(f.fund_table_code) == fo._glcode, "left").drop("_glcode")

    def _allocated_parts(self) -> list[DataFrame]:
        """Lines with their allocation row (if the invoice is posted): those of
        ordinary invoices, which meet it where both are dealt by invoice, and
        those of large ones."""
        lines = self.m.invoice_line_base.select(
            "invoice_record_id", "_line_id", (F.col("line_cnt") + 1).alias("seq"), "paid_amt_cents",
            "fund_code", "vendor_code")
        large = self.m.large_invoices.toDF("invoice_record_id")
        few, many = (ild.select(
            "invoice_record_id", F.col("line_cnt").alias("seq"), F.col("line_cnt").alias("_ild_line"),
            F.col("total_lines").alias("_ild_total"), F.col("paid_amt_cents").alias("_ild_paid"),
            "approx_adj_amt", "running_adjusted_total_paid_cents", "off_amt_cents") for ild in self.m.allocated_parts())
        parts = (join_clustered(join_null_safe(lines, large, ["invoice_record_id"], "left_anti"), few, "invoice_record_id", ["seq"]),
                 join_null_safe(lines, large, ["invoice_record_id"], "left_semi").join(many, ["invoice_record_id", "seq"], "left"))
        amount = (F.when(F.col("_ild_line") == F.col("_ild_total"),
                         F.col("approx_adj_amt") + F.col("_ild_paid") + F.col("off_amt_cents"))
                  .otherwise(F.col("approx_adj_amt") + F.col("_ild_paid")))
        return [j.withColumn("_amount_cents", amount).withColumn("_fund_key", int_prefix("fund_code")) for j in parts]

    def _allocated_lines(self) -> DataFrame:
        few, many = self._allocated_parts()
        return few.unionByName(many)

    @cached_property
    def ledger_export_table(self) -> DataFrame:
        """Detail and heading rows are put together before they meet the
        invoice, so its data is computed and joined once."""
        d = self._allocated_lines()
        detail = d.join(self.current_funds, d._fund_key == F.col("fund_code_num"), "left").select(
            "invoice_record_id", F.lit("D").alias("row_type"), *self.DETAIL_COLUMNS)
        # dealt as the details are, so that these stay where they are
        heading = (self.src.invoice_record.select(F.col("record_id").alias("invoice_record_id")).repartition("invoice_record_id")
                   .withColumn("row_type", F.lit("H")))
        inv = self.invoice_data
        return self._ledger_columns(with_headings(detail, heading).join(inv, "invoice_record_id"), list(self.INVOICE_DATA))

    #: What a detail row has of its own, beside its invoice's data.
    DETAIL_COLUMNS = ("seq", "_amount_cents", "paid_amt_cents", "GLKey", "GLObj")

    @staticmethod
    def _ledger_columns(rows: DataFrame, invoice_columns: list[str]) -> DataFrame:
        """The columns of the export from detail and heading rows with their
        invoice's data."""
        is_head = F.col("row_type") == "H"
        date = F.date_format("invoice_date", US_DATE)
        return rows.select(
            "row_type", F.col("peid").alias("vendor_number"), F.col("ref").alias("invoice_number"),
            F.when(is_head, _money("grand_total_amt_cents")).otherwise(F.col("seq").cast("decimal(14,2)"))
            .alias("invoice_total_or_sequence"),
            F.when(is_head, _money("grand_total_amt_cents")).otherwise(_money("_amount_cents")).alias("net_amount"),
            gl_object_description("GLObj").alias("payment_method_or_description"),
            F.when(is_head, date).otherwise(F.col("GLKey").cast("string")).alias("invoice_date_or_org"),
            F.when(is_head, date).otherwise(F.col("GLObj").cast("string")).alias("due_date_or_object"),
            F.lit("").alias("extra_data"), _money("paid_amt_cents").alias("orig_paid_amt"), *invoice_columns)

    @cached_property
    def ledger_export_view(self) -> DataFrame:
        return self.ledger_export_table.distinct()

    # ------------------------------------------------- V10 second ledger format
    @property
    def _vendor_codes(self) -> DataFrame:
        return self.m.vendor_header.select("vendor_record_code")

    def _charged_parts(self) -> list[DataFrame]:
        # the filters on the allocation's paid amount and the fund's code need
        # both rows to exist, so these two joins are inner
        # (a line with an allocation has an invoice; said, so that all readers of the invoices read the same ones)
        return [d.filter((F.col("_ild_paid") != 0) & F.col("invoice_record_id").isNotNull()) for d in self._allocated_parts()]

    def _paying_parts(self) -> list[DataFrame]:
        funds = self.current_funds.filter(F.col("fund_table_code") != "65535")
        return [d.join(funds, d._fund_key == funds.fund_code_num, "inner") for d in self._charged_parts()]

    @cached_property
    def ledger_lines_alt_counts(self) -> DataFrame:
        """Rows of the second ledger format per payee.  Lines are counted by
        vendor code before anything else is looked up; every allocated line has
        its invoice, so no invoice is read."""
        paying = [d.select("vendor_code") for d in self._paying_parts()]
        lines = reduce(DataFrame.unionByName, paying).groupBy("vendor_code").agg(F.count(F.lit(1)).alias("_lines"))
        carriers = (self._vendor_codes.groupBy(F.col("vendor_record_code").alias("_vc"))
                    .agg(F.count(F.lit(1)).alias("_carriers")))
        d = lines.join(carriers, lines.vendor_code == F.col("_vc"), "left")
        d = self._with_payee(d, "vendor_code", "pe_id")
        return d.groupBy("pe_id").agg(
            F.sum(F.col("_lines") * F.coalesce("_carriers", F.lit(1))).cast("bigint").alias("count"))

    @cached_property
    def ledger_lines_alt_view(self) -> DataFrame:
        d = self._with_carriers(*self._paying_parts())
        return d.select(
            "pe_id", strip_zeros_if_numeric("invoice_number_text").alias("ref"),
            F.lit(ALT_LEDGER_DIVISION).alias("div"), _money("_amount_cents").alias("dist_amt"),
            F.lit(ALT_LEDGER_CHECK_ID).alias("check_id"), F.col("invoice_date").alias("ref_dt"),
            F.col("GLKey").alias("gl_key"), F.col("GLObj").alias("gl_obj"),
            F.lit(ALT_LEDGER_ADDRESS_CODE).alias("alt_addr_cd"), F.lit(None).cast("string").alias("extra_data"),
            "invoice_record_id", "invoice_record_num", F.col("seq").alias("line_cnt"),
            "count_invoice_record_line", _money("paid_amt_cents").alias("orig_dist_amt"),
            F.col("_fund_key").alias("fund_code"), "posted_date", "grand_total_amt_cents", "subtotal_amt_cents",
            "vendor_code", "approx_adj_amt", "running_adjusted_total_paid_cents", "off_amt_cents")

    #: What a row of the second ledger format has of its invoice.
    INVOICE_COLUMNS = ("invoice_record_num", "invoice_number_text", "invoice_date", "posted_date", "grand_total_amt_cents",
                       "subtotal_amt_cents")

    def _carried(self, df: DataFrame) -> DataFrame:
        """Raw (untrimmed) vendor code join of the reference: repeats a row once
        per vendor carrying that code, keeps rows without one; and the payee."""
        v = self._vendor_codes.select(F.col("vendor_record_code").alias("_vc"))
        return self._with_payee(df.join(v, df.vendor_code == F.col("_vc"), "left").drop("_vc"), "vendor_code", "pe_id")

    def _with_carriers(self, few: DataFrame, many: DataFrame) -> DataFrame:
        """Lines with their vendors, payee and invoice.  The vendor codes of an
        ordinary invoice are looked up once each and come to its lines, which
        stay where they are; lines of large invoices travel to the look-ups."""
        large = self.m.large_invoices.toDF("invoice_record_id")
        total = F.sum("n_lines").over(Window.partitionBy("invoice_record_id"))
        pairs = join_null_safe(self._vendor_pairs, large, ["invoice_record_id"], "left_anti").withColumn("count_invoice_record_line", total)
        codes = self._carried(pairs).select("invoice_record_id", "vendor_code", "pe_id", "count_invoice_record_line")
        few = join_clustered(few, codes.repartition("invoice_record_id"), "invoice_record_id", ["vendor_code"], null_safe=True)
        many = self._carried(many).join(self._line_counts, "invoice_record_id")
        h = self.m.invoice_header.select("invoice_record_id", *self.INVOICE_COLUMNS)
        return few.unionByName(many).join(h, "invoice_record_id")

    # --------------------------------------------------- V11 vendor alt codes
    @cached_property
    def invoice_vendor_alt_code_view(self) -> DataFrame:
        # one row per (vendor code, invoice) before any join
        pairs = (self._vendor_pairs.select(F.trim("vendor_code").alias("vendor_code"), "invoice_record_id")
                 .distinct())
        posted = (self.m.invoice_header.filter(F.col("posted_date").isNotNull())
                  .select("invoice_record_id", "posted_date"))
        per_inv = pairs.join(posted, "invoice_record_id")
        v = self.m.vendor_header.select("vendor_record_id", "vendor_record_code", "vendor_name", "vendor_record_num")
        alt = (self.m.varfield.filter(F.col("varfield_type_code") == "d")
               .select(F.col("record_id").alias("_alt_vid"), F.col("field_content").alias("alternate_code")).distinct())
        # distinct: a vendor's equal alternate codes count an invoice once
        va = v.join(alt, F.col("vendor_record_id") == F.col("_alt_vid"), "left")
        j = per_inv.join(va, per_inv.vendor_code == F.col("vendor_record_code"), "left")
        return (j.groupBy("vendor_code", "vendor_name", "vendor_record_num", "alternate_code")
                .agg(F.count(F.lit(1)).cast("bigint").alias("count_invoices"),
                     F.max("posted_date").alias("last_posted_date")))

    # ------------------------------------------- V12 fully paid cost per bib
    @cached_property
    def fully_paid_order_bib_avg_item_cost_view(self) -> DataFrame:
        """Per (title, physical form): fully paid orders' copies, average
        price (floored), first/last order date, count, and the orders nested
        in (date, number) order, orders without a date first."""
        o = (self.m.order_header.filter(F.col("order_status_name") == "FULLY PAID")
             .select("bib_record_num", "order_record_num", "physical_form_name", "estimated_price_cents",
                     "sum_cmf_copies", "order_type_name", F.to_date("order_date_gmt").alias("order_date")))
        keys = ["bib_record_num", "physical_form_name"]
        sums = {n: (F.sum(c), F.sum(n)) for n, c in (("total_copies", "sum_cmf_copies"), ("_price", "estimated_price_cents"))}
        counts = {n: (F.count(c), F.sum(n)) for n, c in (("_prices", "estimated_price_cents"), ("count_order_records", F.lit(1)))}
        dates = {"min_order_date": (F.min("order_date"), F.min("min_order_date")),
                 "max_order_date": (F.max("order_date"), F.max("max_order_date"))}
        d = nest(o, keys, ["order_date", "order_record_num", "order_type_name", "sum_cmf_copies"],
                 ["order_date", "order_record_num"], "order_dates", aggs={**sums, **counts, **dates}, nulls_first=True,
                 chunks=[F.col("order_date"), in_runs("order_record_num")])
        s_, n_ = F.col("_price"), F.col("_prices")
        return d.select(
            *keys, F.col("total_copies").cast("bigint").alias("total_copies"),
            F.when(n_ > 0, F.floor((s_ - F.pmod(s_, n_)) / n_)).cast("bigint").alias("est_avg_price_cents"),
            "min_order_date", "max_order_date", F.col("count_order_records").cast("bigint").alias("count_order_records"),
            "order_dates")

    # ------------------------------------------------------- V13 fund use
    @cached_property
    def fund_use(self) -> DataFrame:
        f = self.m.fund.filter((F.col("fund_type") == "fbal") & (F.col("appropriation") > 0))
        wide = f.select(
            pct_of(F.col("expenditure") + F.col("encumbrance"), "appropriation").alias("total_percent_fund_used"),
            pct_of("expenditure", "appropriation").alias(FUND_USE_SERIES["expenditure"]),
            pct_of("encumbrance", "appropriation").alias(FUND_USE_SERIES["encumbrance"]),
            F.concat(F.coalesce("external_fund_name", F.lit("")), F.lit(" / "),
                     F.coalesce("fund_code", F.lit(""))).alias("fund_name_code"),
            "fund_code", "appropriation", "encumbrance", "expenditure")
        return melt(wide, ["total_percent_fund_used", "fund_name_code", "appropriation", "encumbrance",
                           "expenditure"],
                    [FUND_USE_SERIES["expenditure"], FUND_USE_SERIES["encumbrance"]],
                    "fund_use_type", "percent")
