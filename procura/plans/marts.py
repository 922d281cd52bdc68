"""Mart builders (M1..M11): source relations in, analysis tables out.

Each mart is a lazy DataFrame built from the source relations held by a
``sources`` object (anything with the source relation names as attributes:
:class:`procura.sources.testdata.TestSources`, or
:class:`procura.sources.catalog.SourceCatalog` over parquet / JDBC).

Join strategy: no side but the keys of large invoices carries a broadcast
hint.  Code tables, funds and
vendor look-ups are broadcast by the optimizer (stored tables) or by adaptive
execution (derived sides) where their measured bytes are under
``spark.sql.autoBroadcastJoinThreshold``; larger ones stay shuffle joins with
skew splitting.  Building a mart starts no job.  Record metadata holds a row
for every record of every kind, so it is filtered to one record kind before a
join.  Children (lines, fund children, addresses) are aggregated before they meet
their header, so every header join is one-to-one; the remaining big joins
are shuffle joins on the invoice / order key, where AQE splits skewed
partitions.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procura.functions import digits_key, to_cents
from procura.operators.allocate import DEFAULT_CHUNK_SIZE, allocate, share_cents, with_chunk
from procura.operators.nesting import first_by, in_runs, nest
from procura.operators.reshape import decode
from procura.operators.sizing import join_clustered, join_null_safe, large_groups
from procura.session import materialize

#: Chunks of positions up to which an invoice is allocated in one task.
WHOLE_CHUNKS = 64

INVOICE, ORDER, VENDOR, ITEM, BIB = "n", "o", "v", "i", "b"


def _date(col: str) -> F.Column:
    return F.to_date(F.col(col))


class Marts:
    """All marts over one set of sources.  Attributes are lazy DataFrames."""

    def __init__(self, sources, chunk_size: int = DEFAULT_CHUNK_SIZE, materialize: str = "none"):
        """``materialize`` says how intermediate results that several parts of
        one plan read are computed once (see :func:`procura.session.materialize`)."""
        self.src = sources
        self.chunk_size = chunk_size
        self.materialize_mode = materialize

    def _once(self, df: DataFrame) -> DataFrame:
        return materialize(df, self.materialize_mode)

    # ---------------------------------------------------------------- helpers
    def record_nums(self, kind: str, id_name: str, num_name: str) -> DataFrame:
        """(id, record number) of one record kind, renamed for a join."""
        return (self.src.record_metadata.filter(F.col("record_type_code") == kind)
                .select(F.col("id").alias(id_name), F.col("record_num").alias(num_name)))

    # ---------------------------------------------------------- M1 varfield types
    @cached_property
    def varfield_metadata(self) -> DataFrame:
        vt, rt = self.src.varfield_type, self.src.record_type
        rtn, vtn = self.src.record_type_name, self.src.varfield_type_name
        return (vt.join(rt, rt.code == vt.record_type_code)
                .join(rtn, rtn.record_type_id == rt.id)
                .join(vtn, vtn.varfield_type_id == vt.id)
                .filter(rt.code.isin(INVOICE, ORDER, VENDOR))
                .select(rtn.name.alias("record_type_name"), rt.code.alias("record_type_code"),
                        vt.code.alias("varfield_code"), vt.is_enabled.alias("varfield_is_enabled"),
                        vt.display_order.alias("varfield_display_order"),
                        vtn.short_name.alias("varfield_type_short_name"),
                        vtn.name.alias("varfield_type_name")))

    # --------------------------------------------------------------- M2 varfield
    @cached_property
    def varfield(self) -> DataFrame:
        rm = (self.src.record_metadata.filter(F.col("record_type_code").isin(INVOICE, ORDER, VENDOR))
              .select(F.col("id").alias("record_id"), "record_num", "record_type_code"))
        v = self.src.varfield.select(F.col("id").alias("varfield_id"), "record_id", "varfield_type_code",
                                     "occ_num", "field_content")
        return (rm.join(v, "record_id")
                .select("record_id", "record_num", "record_type_code", "varfield_id",
                        "varfield_type_code", "occ_num", "field_content"))

    # ------------------------------------------------------------------ M3 fund
    def fund_frame(self, how: str = "left") -> DataFrame:
        """Funds with their balances per fund type.  ``how="inner"`` gives the
        older variant that drops funds without balance or external name."""
        fm = self.src.fund_master.select(F.col("id").alias("fund_master_id"), F.col("accounting_unit_id").alias("_au"),
                                         F.col("code_num").alias("fund_code_num"),
                                         F.col("code").alias("fund_master_code"))
        au = self.src.accounting_unit.select(F.col("id").alias("_au_id"),
                                             F.col("code_num").alias("accounting_unit_code_num"))
        fmu = self.src.fund_myuser.withColumnRenamed("fund_master_id", "_fmid")
        efp = self.src.external_fund_property.select(F.col("id").alias("_efp_id"), F.col("code_num").alias("_efp_cn"))
        efpn = self.src.external_fund_property_name.select(F.col("external_fund_property_id").alias("_efpn_id"),
                                                           F.col("name").alias("external_fund_name"))
        d = (fm.join(au, F.col("_au_id") == F.col("_au"))
             .join(fmu, F.col("_fmid") == F.col("fund_master_id"), how)
             .join(efp, F.col("_efp_cn") == F.col("external_fund_code_num"), how)
             .join(efpn, F.col("_efpn_id") == F.col("_efp_id"), how))
        return d.select(
            "fund_master_id", "accounting_unit_code_num", "fund_code_num", "fund_master_code",
            "fund_type", "fund_code", "external_fund_code_num", "external_fund_name",
            F.col("appropriation").cast("bigint").alias("appropriation"),
            F.col("expenditure").cast("bigint").alias("expenditure"),
            F.col("encumbrance").cast("bigint").alias("encumbrance"),
            "num_orders", "num_payments", "warning_percent", "discount_percent", "name", "note1", "note2")

    def fund_by_code(self) -> DataFrame:
        """Draft form of the fund mart: balances matched on the fund code
        (not the master id), external name on the fund's code number; inner
        joins throughout."""
        fm = self.src.fund_master.select(F.col("code_num").alias("fund_code_num"), F.col("code").alias("fund_code"),
                                         F.col("accounting_unit_id").alias("_au"))
        au = self.src.accounting_unit.select(F.col("id").alias("_au_id"),
                                             F.col("code_num").alias("accounting_unit_code_num"))
        efp = self.src.external_fund_property.select(F.col("id").alias("_efp_id"), F.col("code_num").alias("_efp_cn"))
        efpn = self.src.external_fund_property_name.select(F.col("external_fund_property_id").alias("_efpn_id"),
                                                           F.col("name").alias("external_fund_name"))
        bal = self.src.fund_myuser.select(F.col("fund_code").alias("_bal_code"), "fund_type", "appropriation",
                                          "expenditure", "encumbrance", "num_orders", "num_payments",
                                          "warning_percent")
        return (fm.join(au, F.col("_au_id") == F.col("_au"))
                .join(efp, F.col("_efp_cn") == F.col("fund_code_num"))
                .join(efpn, F.col("_efpn_id") == F.col("_efp_id"))
                .join(bal, F.col("_bal_code") == F.col("fund_code"))
                .select("fund_code_num", "fund_code", "accounting_unit_code_num", "external_fund_name", "fund_type",
                        F.col("appropriation").cast("bigint").alias("appropriation"),
                        F.col("expenditure").cast("bigint").alias("expenditure"),
                        F.col("encumbrance").cast("bigint").alias("encumbrance"),
                        "num_orders", "num_payments", "warning_percent"))

    @cached_property
    def fund(self) -> DataFrame:
        return self.fund_frame("left")

    # -------------------------------------------------------------- M4 invoice
    @cached_property
    def invoice_header(self) -> DataFrame:
        """Invoice header columns of the invoice mart (one row per invoice)."""
        ir = self.src.invoice_record
        rm = self.src.record_metadata.filter(F.col("record_type_code") == INVOICE).select(
            F.col("id").alias("_rid"), F.col("record_num").alias("invoice_record_num"),
            _date("creation_date_gmt").alias("creation_date"),
            _date("record_last_updated_gmt").alias("last_updated"))
        return (ir.join(rm, rm._rid == ir.record_id)
                .select(ir.record_id.alias("invoice_record_id"), "invoice_record_num",
                        "invoice_number_text", "creation_date", "last_updated",
                        "accounting_unit_code_num",
                        _date("invoice_date_gmt").alias("invoice_date"),
                        _date("paid_date_gmt").alias("paid_date"),
                        F.col("status_code").alias("invoice_record_status_code"),
                        _date("posted_data_gmt").alias("posted_date"),
                        "is_paid_date_received_date", "staff_user_name", "foreign_currency_code",
                        "foreign_currency_format", "foreign_currency_exchange_rate",
                        "tax_fund_code", "tax_type_code",
                        to_cents("discount_amt").alias("discount_amt_cents"),
                        to_cents("grand_total_amt").alias("grand_total_amt_cents"),
                        to_cents("subtotal_amt").alias("subtotal_amt_cents"),
                        to_cents("shipping_amt").alias("shipping_amt_cents"),
                        to_cents("total_tax_amt").alias("total_tax_amt_cents"),
                        "use_tax_fund_code", "use_tax_percentage_rate", "use_tax_type_code",
                        "use_tax_ship_service_code", "is_suppressed"))

    LINE_FIELDS = ("line_cnt", "order_record_id", "order_record_num", "title", "paid_amt_cents",
                   "lien_amt_cents", "lien_flag", "list_price_cents", "fund_code", "subfund_num",
                   "copies_paid_cnt", "external_fund_code_num", "status_code", "note",
                   "is_single_copy_partial_pmt", "multiflag_code", "line_level_tax_cents", "vendor_code",
                   "accounting_transaction_voucher_num", "accounting_transaction_voucher_seq_num",
                   "invoice_record_vendor_summary_id", "is_use_tax", "approx_adjust_amt")

    def invoice_lines_frame(self, how: str = "left") -> DataFrame:
        """One row per (invoice, line) - the unnested form of the invoice mart.

        ``how="left"``: every invoice appears; an invoice without lines has
        one row whose line fields are all null (what unnesting the nested
        mart gives) and lines without an order are kept.  ``how="inner"``:
        the older variant - only lines of a known order, only invoices with
        such lines."""
        ir = self.src.invoice_record.select(
            F.col("record_id").alias("invoice_record_id"), "subtotal_amt", "grand_total_amt")
        il = self.src.invoice_record_line
        lines = il.select(il.invoice_record_id.alias("_iid"), il.id.alias("_line_id"), "line_cnt",
                          il.order_record_metadata_id.alias("order_record_id"),
                          "title", "paid_amt", "lien_amt", "lien_flag", "list_price", "fund_code",
                          "subfund_num", "copies_paid_cnt", "external_fund_code_num", "status_code", "note",
                          "is_single_copy_partial_pmt", "multiflag_code", "line_level_tax", "vendor_code",
                          "accounting_transaction_voucher_num", "accounting_transaction_voucher_seq_num",
                          "invoice_record_vendor_summary_id", "is_use_tax")
        j = self._with_order_numbers(ir.join(lines, ir.invoice_record_id == lines._iid, how).drop("_iid"), how)
        return j.select(
            "invoice_record_id", "_line_id",
            *[F.col(c) for c in ("line_cnt", "order_record_id", "order_record_num", "title")],
            to_cents("paid_amt").alias("paid_amt_cents"),
            to_cents("lien_amt").alias("lien_amt_cents"), "lien_flag",
            to_cents("list_price").alias("list_price_cents"), "fund_code", "subfund_num",
            "copies_paid_cnt", "external_fund_code_num", "status_code", "note",
            "is_single_copy_partial_pmt", "multiflag_code",
            to_cents("line_level_tax").alias("line_level_tax_cents"), "vendor_code",
            "accounting_transaction_voucher_num", "accounting_transaction_voucher_seq_num",
            "invoice_record_vendor_summary_id", "is_use_tax",
            share_cents("paid_amt", "subtotal_amt", "grand_total_amt").alias("approx_adjust_amt"))

    @property
    def _order_pairs(self) -> DataFrame:
        """Distinct (invoice, order) of the lines.  Their ids are counted, so
        that this reads the very lines that the other readers of a plan read."""
        return (self.src.invoice_record_line.groupBy("invoice_record_id", F.col("order_record_metadata_id").alias("order_record_id"))
                .agg(F.count("id").alias("_ids")).filter("_ids >= 0").drop("_ids"))

    def _with_order_numbers(self, lines: DataFrame, how: str) -> DataFrame:
        """Lines (dealt by invoice, as they met it) with their order's number.
        The order ids of an ordinary invoice travel to the orders and come back
        with the numbers, its lines stay; lines of large invoices travel."""
        orm = self.record_nums(ORDER, "_oid", "order_record_num")
        large = self.large_invoices.toDF("invoice_record_id")
        pairs = join_null_safe(self._order_pairs, large, ["invoice_record_id"], "left_anti")
        numbers = pairs.join(orm, F.col("order_record_id") == F.col("_oid")).select(
            "invoice_record_id", "order_record_id", "order_record_num").repartition("invoice_record_id")
        few = join_clustered(join_null_safe(lines, large, ["invoice_record_id"], "left_anti"), numbers,
                             "invoice_record_id", ["order_record_id"], how)
        many = join_null_safe(lines, large, ["invoice_record_id"], "left_semi").join(
            orm, F.col("order_record_id") == F.col("_oid"), how).drop("_oid")
        return few.unionByName(many)

    @cached_property
    def invoice_lines_flat(self) -> DataFrame:
        """The flat invoice lines (left variant).  Read by the nested mart and
        by most report views, so no view depends on one row per invoice
        holding all of its lines; computed once per plan."""
        return self._once(self.invoice_lines_frame("left"))

    @cached_property
    def invoice_line_base(self) -> DataFrame:
        """The flat invoice lines without what needs the order or the share:
        what the reports read (from the stored flat lines if there are any).
        ``_line`` is null where an invoice has no line; it is made of the
        line's id too, so that those who count lines read what the others read."""
        names = ["invoice_record_id", "_line_id", "_line", "line_cnt", "paid_amt_cents", "fund_code", "vendor_code"]
        if "invoice_lines_flat" in self.__dict__:
            return self.invoice_lines_flat.withColumn("_line", F.col("_line_id")).select(*names)
        ir = self.src.invoice_record.select(F.col("record_id").alias("invoice_record_id"))
        il = self.src.invoice_record_line.select(
            F.col("invoice_record_id").alias("_iid"), F.col("id").alias("_line_id"), "line_cnt",
            to_cents("paid_amt").alias("paid_amt_cents"), "fund_code", "vendor_code").withColumn("_line", F.coalesce("_line_id", "_iid"))
        return ir.join(il, ir.invoice_record_id == il._iid, "left").select(*names)

    def invoice_frame(self, how: str = "left", allocation: bool = True) -> DataFrame:
        """M4: invoices with their lines nested in line order.

        One row per invoice: lines sorted by chunk of positions, one aggregate
        per invoice over its chunks, one join with the header.  ``how="inner", allocation=False`` is the older variant (lines
        of known orders only, no allocated share per line)."""
        flat = self.invoice_lines_flat if how == "left" else self.invoice_lines_frame(how)
        fields = [f for f in self.LINE_FIELDS if allocation or f != "approx_adjust_amt"]
        nested = nest(flat, key="invoice_record_id", fields=fields, order=["line_cnt", "order_record_id", "_line_id"],
                      out="json_invoice_record_line", count_of="_line_id", count_out="count_invoice_record_line")
        h = self.invoice_header
        lead = ["invoice_record_id", "invoice_record_num", "invoice_number_text"]
        return nested.join(h, "invoice_record_id").select(
            *lead, "count_invoice_record_line", "json_invoice_record_line", *[c for c in h.columns if c not in lead])

    @cached_property
    def invoice(self) -> DataFrame:
        return self.invoice_frame("left", allocation=True)

    # -------------------------------------------------- M5 invoice line allocation
    @cached_property
    def invoice_line_data(self) -> DataFrame:
        """M5: per posted invoice line, its share of the invoice's extra
        charges, the running adjusted total and the residual on the last line."""
        few, many = self.allocated_parts()
        return few.unionByName(many)

    def allocated_parts(self) -> tuple[DataFrame, DataFrame]:
        """M5 of the ordinary invoices and of the large ones (by record id)."""
        if "invoice_line_data" in self.__dict__:
            large = self.large_invoices.toDF("invoice_record_id")
            return tuple(join_null_safe(self.invoice_line_data, large, ["invoice_record_id"], how) for how in ("left_anti", "left_semi"))
        ir = (self.src.invoice_record.filter(F.col("posted_data_gmt").isNotNull())
              .select(F.col("id").alias("_iid"), F.col("record_id").alias("invoice_record_id"),
                      "subtotal_amt", "grand_total_amt"))
        rm = self.record_nums(INVOICE, "_rid", "invoice_record_num")
        il = self.src.invoice_record_line.select(F.col("invoice_record_id").alias("_lid"), "line_cnt",
                                                 "paid_amt")
        heads = ir.join(rm, rm._rid == ir.invoice_record_id)
        large = self.large_invoices.toDF("invoice_record_id")
        return tuple(self._allocated(join_null_safe(heads, large, ["invoice_record_id"], how), il, whole)
                     for how, whole in (("left_anti", True), ("left_semi", False)))

    @property
    def large_invoices(self) -> DataFrame:
        """Ids (``_lid``) of the invoices of more than ``WHOLE_CHUNKS`` chunks of
        lines, told from cheaper rows than the lines where the sources have them."""
        told = getattr(type(self.src), "line_sizes", None)
        rows = told(self.src, "invoice_record_line") if told else self.src.invoice_record_line.select("invoice_record_id")
        return large_groups(rows.toDF("_lid"), ["_lid"], WHOLE_CHUNKS * self.chunk_size)

    def _allocated(self, heads: DataFrame, il: DataFrame, whole: bool) -> DataFrame:
        """The allocation of the lines ``il``.  Lines of ordinary invoices
        (``whole``) meet their invoice, are merged and added up on one
        clustering by invoice; those of invoices beyond ``WHOLE_CHUNKS`` chunks
        of positions are dealt by chunk, so that no step works on a whole
        invoice at once."""
        base = heads.join(il, il._lid == heads._iid).withColumn("line_cnt", (F.col("line_cnt") + 1).cast("int"))
        keys = ["invoice_record_id", "invoice_record_num", "paid_amt", "subtotal_amt", "grand_total_amt", "line_cnt"]
        if whole:
            # one clustering by invoice serves the merge, the sums and the join of the lines with their allocation
            base = base.select(*keys).repartition("invoice_record_id")
        else:
            # one repartition by (invoice, chunk) serves the merge and the per-chunk totals
            base = with_chunk(base, "invoice_record_id", "line_cnt", self.chunk_size, repartition=True)
            keys.append("_chunk")
        # identical (paid amount, position) lines of an invoice are merged; the
        # line count still counts every line
        merged = (base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                  .withColumn("paid_amt_cents", to_cents("paid_amt")))
        # the rows feed both the per-chunk totals and the join back: compute once
        merged = merged if whole else self._once(merged)
        out = allocate(merged, "invoice_record_id", "line_cnt", "paid_amt_cents", "subtotal_amt", "grand_total_amt",
                       line_count="total_lines", count_col="_n", chunk_size=self.chunk_size, whole=whole)
        return out.select(
            "invoice_record_id", "invoice_record_num", "line_cnt",
            F.col("total_lines").cast("bigint").alias("total_lines"), "paid_amt_cents",
            to_cents("grand_total_amt").alias("grand_total_amt_cents"),
            to_cents("subtotal_amt").alias("subtotal_amt_cents"),
            "approx_adj_amt", "running_adjusted_total_paid_cents", "is_off", "off_amt_cents")

    # --------------------------------------------------- M6 invoice-order link
    @cached_property
    def invoice_record_order_record_link(self) -> DataFrame:
        pairs = self._order_pairs
        irm = self.record_nums(INVOICE, "_iid", "invoice_record_num")
        orm = self.record_nums(ORDER, "_oid", "order_record_num")
        return (pairs.join(irm, irm._iid == pairs.invoice_record_id)
                .join(orm, orm._oid == pairs.order_record_id)
                .select("invoice_record_id", "invoice_record_num", "order_record_id", "order_record_num")
                .distinct())

    # -------------------------------------------------- M7 invoice-vendor link
    @cached_property
    def invoice_record_vendor_record_link(self) -> DataFrame:
        s = self.src.invoice_record_vendor_summary
        irm = self.record_nums(INVOICE, "_iid", "invoice_record_num")
        vr = self.src.vendor_record.select(F.col("record_id").alias("vendor_record_id"),
                                           F.col("code").alias("_vcode"))
        vrm = self.record_nums(VENDOR, "_vid", "vendor_record_num")
        return (s.join(irm, irm._iid == s.invoice_record_id, "left")
                .join(vr.join(vrm, vrm._vid == vr.vendor_record_id, "left"),
                      F.col("_vcode") == s.vendor_code, "left")
                .select("invoice_record_id", "invoice_record_num", "vendor_record_id", "vendor_record_num",
                        "vendor_code", "voucher_num", "voucher_total", "display_order"))

    # ---------------------------------------------------------------- M8 orders
    @cached_property
    def order_funds_flat(self) -> DataFrame:
        """Fund children of orders, one row each (summary rows at location
        ``multi`` excluded), with the fund resolved by the digits of the
        child's fund code.  The flat form the reports read; the order header
        and the nested mart both read it, so it is computed once."""
        return self._once(self.order_funds_frame())

    def order_funds_frame(self, fund_code: str | None = None) -> DataFrame:
        """The fund children as a lazy plan (see :attr:`order_funds_flat`);
        with ``fund_code`` only those of this fund, whose few rows are
        broadcast, so that no child is shuffled to meet its fund."""
        cmf = self.src.order_record_cmf.filter(F.col("location_code") != "multi")
        fm = self.src.fund_master.select(F.col("code_num").alias("fund_code_num"),
                                         F.col("code").alias("_fm_code"), "accounting_unit_id")
        au = self.src.accounting_unit.select(F.col("id").alias("_au_id"),
                                             F.col("code_num").alias("acct_unit_code_num"))
        # funds: few rows but hot keys on the children side -> checked broadcast
        funds, how = fm.join(au, au._au_id == fm.accounting_unit_id, "left"), "left"
        if fund_code is not None:
            funds, how = F.broadcast(funds.filter(F.col("_fm_code") == fund_code)), "inner"
        return (cmf.withColumn("_fkey", digits_key("fund_code"))
                .join(funds, F.col("_fkey") == F.col("fund_code_num"), how)
                .select("order_record_id", "display_order", F.col("id").alias("cmf_id"), "fund_code_num",
                        F.col("_fm_code").alias("fund_code"), "acct_unit_code_num", "copies",
                        "location_code", F.col("fund_code").alias("_raw_fund_code")))

    @cached_property
    def order_header(self) -> DataFrame:
        """Order-grain part of M8: one row per order (x bib link x vendor
        match) with the aggregates of its fund children (except summary rows
        at location ``multi``), without the nested children.  Reports that
        count or list orders read this."""
        kids = self.order_funds_flat
        agg = (kids.groupBy("order_record_id")
               .agg(F.count("cmf_id").cast("bigint").alias("count_cmf"),
                    F.countDistinct("_raw_fund_code").cast("bigint").alias("count_distinct_cmf_fund_codes"),
                    F.sum("copies").cast("bigint").alias("sum_cmf_copies")))
        orr = self.src.order_record
        rm = self.src.record_metadata.filter(F.col("record_type_code") == ORDER).select(
            F.col("id").alias("_oid"), F.col("record_num").alias("order_record_num"), "creation_date_gmt")
        link = self.src.bib_record_order_record_link.select(
            F.col("order_record_id").alias("_lo"), "orders_display_order", "bib_record_id")
        bibm = self.record_nums(BIB, "_bid", "bib_record_num")
        fp, fpn = self.src.form_property, self.src.form_property_name
        otpm = self.src.order_type_property_myuser.select("code", "name")
        osp, ospn = self.src.order_status_property, self.src.order_status_property_name
        vr = self.src.vendor_record.select(F.col("record_id").alias("vendor_record_id"),
                                           F.col("code").alias("_vcode"))
        forms = fp.join(fpn, fpn.form_property_id == fp.id).select("code", "name")
        statuses = osp.join(ospn, ospn.order_status_property_id == osp.id).select("code", "name")
        # the aggregate starts from the order table in the reference, so only
        # children of known orders count: an inner join here is the same
        d = (agg.join(orr, orr.record_id == agg.order_record_id, "inner")
             .join(rm, rm._oid == orr.record_id, "left")
             .join(link, link._lo == orr.record_id, "left")
             .join(bibm, bibm._bid == link.bib_record_id, "left")
             .join(vr, F.col("_vcode") == orr.vendor_record_code, "left"))
        for code, names, out in (("form_code", forms, "physical_form_name"), ("order_type_code", otpm, "order_type_name"),
                                 ("order_status_code", statuses, "order_status_name")):
            d = decode(d, code, names, out)
        return d.select(
            "order_record_num", agg.order_record_id, "count_cmf", "count_distinct_cmf_fund_codes",
            "sum_cmf_copies", "orders_display_order", "bib_record_id", "bib_record_num",
            "creation_date_gmt", orr.accounting_unit_code_num,
            to_cents(orr.estimated_price).alias("estimated_price_cents"),
            orr.form_code.alias("physical_form_code"), "physical_form_name",
            orr.order_date_gmt, orr.catalog_date_gmt, orr.order_type_code, "order_type_name",
            orr.received_date_gmt, orr.receiving_location_code, orr.order_status_code, "order_status_name",
            orr.vendor_record_code, "vendor_record_id", orr.volume_count)

    ORDER_CHILD_FIELDS = ("display_order", "cmf_id", "fund_code_num", "fund_code", "acct_unit_code_num", "copies",
                          "location_code")

    @cached_property
    def orders(self) -> DataFrame:
        """M8: orders with their fund children nested in display order, one
        row per order (x bib link x vendor match)."""
        kids = nest(self.order_funds_flat, "order_record_id", list(self.ORDER_CHILD_FIELDS),
                    ["display_order", "cmf_id"], "cmf_data")
        h = self.order_header
        cols = h.columns
        i = cols.index("sum_cmf_copies") + 1
        return h.join(kids, "order_record_id").select(*cols[:i], "cmf_data", *cols[i:])

    # --------------------------------------------------------------- M9 vendors
    @cached_property
    def vendor_addresses(self) -> DataFrame:
        """Vendor addresses with their type code, one row each (flat form;
        read by the vendor header and the nested mart, computed once)."""
        vra = self.src.vendor_record_address
        vrat = self.src.vendor_record_address_type.select(F.col("id").alias("_tid"),
                                                          F.col("code").alias("address_type_code"))
        return self._once(vra.join(vrat, F.col("_tid") == vra.vendor_record_address_type_id)
                          .select("vendor_record_id", "address_type_code", "display_order", "addr1", "addr2",
                                  "addr3", "village", "city", "region", "postal_code", "country",
                                  F.col("id").alias("vendor_record_address_id")))

    ADDRESS_ORDER = ("address_type_code", "display_order", "vendor_record_address_id")

    @cached_property
    def vendor_header(self) -> DataFrame:
        """Vendor-grain part of M9: vendors with at least one address, the
        address count and the name (addr1 of the first address by type code,
        display order, id), without the nested addresses."""
        addrs = self.vendor_addresses
        agg = (addrs.groupBy("vendor_record_id")
               .agg(F.count("vendor_record_address_id").cast("bigint").alias("count_address"),
                    first_by("addr1", list(self.ADDRESS_ORDER)).alias("vendor_name")))
        vr = self.src.vendor_record.select(F.col("record_id").alias("vendor_record_id"),
                                           F.col("code").alias("vendor_record_code"),
                                           "accounting_unit_code_num")
        rm = self.src.record_metadata.filter(F.col("record_type_code") == VENDOR).select(
            F.col("id").alias("_vid"), F.col("record_num").alias("vendor_record_num"),
            _date("creation_date_gmt").alias("record_create_date"),
            _date("record_last_updated_gmt").alias("record_last_updated"), "num_revisions")
        return (agg.join(vr, "vendor_record_id")
                .join(rm, rm._vid == F.col("vendor_record_id"))
                .select("vendor_record_id", "vendor_record_num", "record_create_date", "record_last_updated",
                        "num_revisions", "vendor_name", "vendor_record_code", "accounting_unit_code_num",
                        "count_address"))

    @cached_property
    def vendors(self) -> DataFrame:
        """M9: vendors with their addresses nested in (type code, display
        order, id) order, one row per vendor."""
        fields = ["address_type_code", "display_order", "addr1", "addr2", "addr3", "village", "city",
                  "region", "postal_code", "country", "vendor_record_address_id"]
        addresses = nest(self.vendor_addresses, "vendor_record_id", fields, list(self.ADDRESS_ORDER),
                         "vendor_record_address", chunks=[F.col("address_type_code"), in_runs("display_order")])
        return self.vendor_header.join(addresses, "vendor_record_id").select(
            *self.vendor_header.columns, "vendor_record_address")

    # ----------------------------------------------- M10 invoice vendor summary
    @cached_property
    def invoice_record_vendor_summary(self) -> DataFrame:
        s = self.src.invoice_record_vendor_summary
        irm = self.record_nums(INVOICE, "_iid", "invoice_record_num")
        ir = self.src.invoice_record.select(F.col("id").alias("_irid"), "invoice_number_text",
                                            "invoice_date_gmt")
        return (s.join(irm, irm._iid == s.invoice_record_id)
                .join(ir, ir._irid == s.invoice_record_id)
                .select(s.id.alias("invoice_record_vendor_summary_id"), "invoice_number_text",
                        "invoice_record_id", "invoice_record_num", "vendor_code", "voucher_num",
                        F.col("voucher_total").alias("voucher_total_cents"), "display_order",
                        _date("invoice_date_gmt").alias("invoice_date")))

    # -------------------------------------------------- M11 order receipts
    @cached_property
    def order_record_received(self) -> DataFrame:
        """Receipts with the order number, item number and the item's
        first barcode (lowest occurrence); misses stay null."""
        orr = self.src.order_record_received
        orm = self.record_nums(ORDER, "_oid", "order_record_num")
        irm = self.record_nums(ITEM, "_itid", "item_record_num")
        bc = (self.src.varfield.filter(F.col("varfield_type_code") == "b")
              .groupBy(F.col("record_id").alias("_bid"))
              .agg(first_by("field_content", ["occ_num", "id"]).alias("existing_item_barcode")))
        return (orr.join(orm, orm._oid == orr.order_record_id, "left")
                .join(irm, irm._itid == orr.item_record_metadata_id, "left")
                .join(bc, bc._bid == orr.item_record_metadata_id, "left")
                .select(orr.id.alias("order_record_received_id"), "order_record_id", "order_record_num",
                        "location_code", "fund_code", "copy_num", "volume_num",
                        F.col("item_record_metadata_id").alias("item_record_id"), "item_record_num",
                        "existing_item_barcode", _date("received_date_gmt").alias("received_date"),
                        "display_order"))
