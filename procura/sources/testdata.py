"""Derive the acquisitions source relations from the driver's test tables.

The test tables are a TPC-H-like star schema.  This module maps them onto the
relations the marts read (invoices and their lines, orders and their fund
children, vendors, funds, variable fields, record metadata ...), following the
mapping written down in FIXTURES.md section 3.  Every relation is a lazy
DataFrame over the parquet scans, so all work grows with the input tables.

Id rule: record ids are unique across record kinds, so every record id has its
kind in the bits from 56 up and the base key below (modulo rules use the base
key).  Line ids hold the invoice key above 22 bits of the line's position: room
for 2^41 invoice keys and four million lines an invoice.
Money starts as integer cents ``cast(round(x * 100) as bigint)`` and decimals
are derived from cents, never cast from doubles.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.operators.sizing import row_number_chunked

# Fixed values of the test mapping (FIXTURES.md section 3).
INVOICE_OFFSET, ORDER_OFFSET, VENDOR_OFFSET, ITEM_OFFSET, BIB_OFFSET = (kind << 56 for kind in (1, 2, 3, 4, 5))
#: An invoice of several thousand lines: the seventh lines of the first orders.
LONG_INVOICE, LONG_INVOICE_ORDERS = 501, 10_000
RECORD_NUM_BASE = 1_000_000
CREATED_GMT = "2020-01-01 00:00:00"
UPDATED_GMT = "2020-06-01 12:00:00"
LINELESS_INVOICE_DATE = "2001-01-01"

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _cents_to_money(col: str, precision: int = 12) -> F.Column:
    """Exact decimal dollars from integer cents."""
    return (F.col(col).cast(f"decimal({precision},0)") / F.lit(100)).cast(f"decimal({precision},2)")


class TestSources:
    """Source relations derived from ``{sf_dir}/*.parquet``.

    Attribute access returns a lazy DataFrame; nothing is computed here.
    """

    __test__ = False  # not a pytest test class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ------------------------------------------------------------------ lines
    @cached_property
    def _line_keys(self) -> DataFrame:
        """lineitem with the key of its invoice."""
        return self.table("lineitem").withColumn("invoice_record_id", F.expr(
            f"case when l_linenumber = 7 and l_orderkey < {LONG_INVOICE_ORDERS} then {LONG_INVOICE} "
            "else l_suppkey * 1000 + (year(l_shipdate) - 1990) * 12 + month(l_shipdate) end") + INVOICE_OFFSET)

    @cached_property
    def _line_base(self) -> DataFrame:
        """lineitem joined to part."""
        li = self._line_keys
        part = self.table("part").select("p_partkey", *self.PART_COLUMNS)
        return li.join(part, li.l_partkey == part.p_partkey, "inner").drop("p_partkey")

    PART_COLUMNS = ("p_name", "p_brand", "p_type", "p_retailprice")

    @cached_property
    def _lines(self) -> DataFrame:
        """One row per line item with its place ``pos`` inside the monthly
        invoice and its line position: the place, but for some lines that share
        the position before them and a few that have none.

        The numbering orders by every column that a line has, so it is the same
        for all readers of one plan, and they read one and the same shuffle of
        the lines.  What can be computed from a line is computed after it."""
        # numbered per (invoice, ship day, order-key range) with offsets, so a
        # supplier with a huge share of the lines is not numbered in one task
        order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
                 "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_suppkey", *self.PART_COLUMNS]
        levels = [F.col("l_shipdate"), F.floor(F.col("l_orderkey") / 65536)]
        return (row_number_chunked(self._line_base, ["invoice_record_id"], order, levels, "pos", zero_based=True,
                                   counted=self._line_keys)
                .withColumn("line_cnt", F.expr(
                    "cast(case when pos % 89 = 88 then null when pos % 13 = 12 then pos - 1 else pos end as int)"))
                .withColumn("ik", F.col("invoice_record_id") - INVOICE_OFFSET)
                .withColumn("paid_cents", F.expr("cast(round(l_extendedprice * 100) as bigint)"))
                .withColumn("disc100", F.expr("cast(round(l_discount * 100) as bigint)"))
                .withColumn("tax100", F.expr("cast(round(l_tax * 100) as bigint)"))
                .withColumn("charged_cents", F.expr(
                    "(paid_cents * (100 - disc100) * (100 + tax100) + 5000) div 10000")))

    def line_sizes(self, relation: str) -> DataFrame:
        """Rows that tell how many lines an invoice has, near enough to choose
        how to work on it, without meeting the parts."""
        return self._line_keys.select("invoice_record_id")

    @cached_property
    def invoice_record_line(self) -> DataFrame:
        return self._lines.select(
            (F.col("ik") * (1 << 22) + F.col("pos")).alias("id"),
            "invoice_record_id",
            F.col("line_cnt"),
            F.expr(f"case when l_returnflag = 'R' and l_linestatus = 'F' then cast(null as bigint) "
                   f"else l_orderkey + {ORDER_OFFSET} end").alias("order_record_metadata_id"),
            F.col("p_name").alias("title"),
            _cents_to_money("paid_cents").alias("paid_amt"),
            (F.expr("(paid_cents * disc100) div 100").cast("decimal(12,0)") / 100).cast("decimal(12,2)").alias("lien_amt"),
            F.col("l_returnflag").alias("lien_flag"),
            (F.expr("cast(round(p_retailprice * 100) as bigint)").cast("decimal(12,0)") / 100)
            .cast("decimal(12,2)").alias("list_price"),
            F.expr("case when p_type = 'PROMO' then 'none' else regexp_replace(p_brand, '[^0-9]', '') end")
            .alias("fund_code"),
            F.expr("cast(l_linenumber % 3 as int)").alias("subfund_num"),
            F.expr("cast(l_quantity as int)").alias("copies_paid_cnt"),
            F.expr("case when p_type = 'PROMO' then cast(null as int) "
                   "else cast(regexp_replace(p_brand, '[^0-9]', '') as int) end").alias("external_fund_code_num"),
            F.col("l_linestatus").alias("status_code"),
            F.lit(None).cast("string").alias("note"),
            F.expr("l_quantity < 2").alias("is_single_copy_partial_pmt"),
            F.col("l_returnflag").alias("multiflag_code"),
            (F.expr("(paid_cents * tax100) div 100").cast("decimal(12,0)") / 100).cast("decimal(12,2)")
            .alias("line_level_tax"),
            F.expr("case when l_suppkey % 4 = 0 then concat(' v', l_suppkey, ' ') else concat('v', l_suppkey) end")
            .alias("vendor_code"),
            F.col("ik").alias("accounting_transaction_voucher_num"),
            (F.col("line_cnt") + 1).alias("accounting_transaction_voucher_seq_num"),
            (F.col("ik") + INVOICE_OFFSET).alias("invoice_record_vendor_summary_id"),
            F.expr("tax100 > 5").alias("is_use_tax"),
        )

    # --------------------------------------------------------------- invoices
    @cached_property
    def _invoice_totals(self) -> DataFrame:
        """One row per invoice that has lines, with its totals.  They are added
        up on the shuffle that numbers the lines, then dealt by invoice once
        for all readers: no reader may leave out a total, or it would have a
        shuffle of its own."""
        sums = {"sub_c": "paid_cents", "grand_c": "charged_cents", "disc_c": "(paid_cents * disc100) div 100",
                "tax_c": "(paid_cents * tax100) div 100"}
        each = (self._lines.groupBy("invoice_record_id")
                .agg(*[F.sum(F.expr(e)).cast("bigint").alias(n) for n, e in sums.items()],
                     F.min(F.to_date("l_shipdate")).alias("first_d"), F.max(F.to_date("l_shipdate")).alias("last_d"),
                     F.max("pos").alias("last_pos")))
        whole = each.repartition("invoice_record_id").groupBy("invoice_record_id").agg(
            *[F.sum(n).cast("bigint").alias(n) for n in sums], F.min("first_d").alias("first_d"), F.max("last_d").alias("last_d"),
            F.max("last_pos").alias("last_pos"))
        has_lines = F.coalesce("last_pos", *sums, F.unix_date("first_d"), F.unix_date("last_d")).isNotNull()
        return whole.filter(has_lines).withColumn("ik", F.col("invoice_record_id") - INVOICE_OFFSET)

    @cached_property
    def invoice_record(self) -> DataFrame:
        g = self._invoice_totals.drop("last_pos")
        lineless = (self.table("supplier")
                    .select((F.col("s_suppkey") * 1000 + (999 + INVOICE_OFFSET)).alias("invoice_record_id"),
                            F.lit(0).cast("bigint").alias("sub_c"),
                            F.lit(0).cast("bigint").alias("grand_c"),
                            F.lit(0).cast("bigint").alias("disc_c"),
                            F.lit(0).cast("bigint").alias("tax_c"),
                            F.lit(LINELESS_INVOICE_DATE).cast("date").alias("first_d"),
                            F.lit(LINELESS_INVOICE_DATE).cast("date").alias("last_d"),
                            (F.col("s_suppkey") * 1000 + 999).alias("ik")))
        u = g.unionByName(lineless)
        ts = lambda c: F.col(c).cast("timestamp_ntz")
        return u.select(
            F.col("invoice_record_id").alias("id"),
            F.col("invoice_record_id").alias("record_id"),
            F.expr("case ik % 4 when 0 then concat('000', ik) when 1 then concat('00', ik, 'CO') "
                   "when 2 then '0000' else concat('0', ik) end").alias("invoice_number_text"),
            F.expr("case when ik % 5 = 0 then 'a' else 'p' end").alias("status_code"),
            F.lit(1).alias("accounting_unit_code_num"),
            ts("first_d").alias("invoice_date_gmt"),
            F.expr("case when ik % 7 = 0 then cast(null as timestamp_ntz) else cast(last_d as timestamp_ntz) end")
            .alias("paid_date_gmt"),
            F.expr("case when ik % 5 = 0 then cast(null as timestamp_ntz) else cast(last_d as timestamp_ntz) end")
            .alias("posted_data_gmt"),
            F.expr("ik % 2 = 0").alias("is_paid_date_received_date"),
            F.expr("concat('user', ik % 10)").alias("staff_user_name"),
            F.lit("USD").alias("foreign_currency_code"),
            F.lit(None).cast("string").alias("foreign_currency_format"),
            F.lit(1).cast("decimal(18,6)").alias("foreign_currency_exchange_rate"),
            F.lit(None).cast("string").alias("tax_fund_code"),
            F.lit(None).cast("string").alias("tax_type_code"),
            _cents_to_money("disc_c", 14).alias("discount_amt"),
            _cents_to_money("grand_c", 14).alias("grand_total_amt"),
            _cents_to_money("sub_c", 14).alias("subtotal_amt"),
            F.lit(0).cast("decimal(14,2)").alias("shipping_amt"),
            _cents_to_money("tax_c", 14).alias("total_tax_amt"),
            F.lit(None).cast("string").alias("use_tax_fund_code"),
            F.lit(None).cast("decimal(18,6)").alias("use_tax_percentage_rate"),
            F.lit(None).cast("string").alias("use_tax_type_code"),
            F.lit(None).cast("string").alias("use_tax_ship_service_code"),
            F.lit(False).alias("is_suppressed"),
        )

    @cached_property
    def invoice_record_vendor_summary(self) -> DataFrame:
        return (self._lines
                .withColumn("vendor_code", F.expr(
                    "case when l_suppkey % 4 = 0 then concat(' v', l_suppkey, ' ') else concat('v', l_suppkey) end"))
                .groupBy("ik", "vendor_code")
                .agg(F.min("line_cnt").cast("int").alias("voucher_num"),
                     F.sum("charged_cents").cast("bigint").alias("voucher_total"))
                .select((F.col("ik") + INVOICE_OFFSET).alias("id"),
                        (F.col("ik") + INVOICE_OFFSET).alias("invoice_record_id"),
                        F.trim("vendor_code").alias("vendor_code"),
                        "voucher_num", "voucher_total",
                        F.lit(0).alias("display_order")))

    # ----------------------------------------------------------------- orders
    @cached_property
    def _orders(self) -> DataFrame:
        o = self.table("orders")
        c = self.table("customer").select("c_custkey", "c_mktsegment")
        return o.join(c, o.o_custkey == c.c_custkey, "inner")

    @cached_property
    def order_record(self) -> DataFrame:
        return self._orders.select(
            (F.col("o_orderkey") + ORDER_OFFSET).alias("record_id"),
            F.lit(1).alias("accounting_unit_code_num"),
            (F.expr("cast(round(o_totalprice * 100) as bigint)").cast("decimal(12,0)") / 100)
            .cast("decimal(12,2)").alias("estimated_price"),
            F.expr("substring(o_orderpriority, 1, 1)").alias("form_code"),
            F.expr("lower(substring(c_mktsegment, 1, 3))").alias("order_type_code"),
            F.expr("concat('rl', o_orderkey % 4)").alias("receiving_location_code"),
            F.expr("lower(o_orderstatus)").alias("order_status_code"),
            F.expr("concat('v', o_orderkey % 10)").alias("vendor_record_code"),
            F.expr("case when o_orderkey % 11 = 5 then cast(null as timestamp_ntz) else o_orderdate end")
            .alias("order_date_gmt"),
            F.expr("case when o_orderstatus = 'O' then cast(null as timestamp_ntz) else o_orderdate end")
            .alias("catalog_date_gmt"),
            F.expr("case when o_orderstatus = 'F' then o_orderdate + interval 30 days "
                   "else cast(null as timestamp_ntz) end").alias("received_date_gmt"),
            F.expr("cast(o_orderkey % 3 as int)").alias("volume_count"),
        )

    def _decode_pairs(self, code_expr: str, name_expr: str, drop_code: str) -> DataFrame:
        return (self._orders.select(F.expr(code_expr).alias("code"), F.expr(name_expr).alias("name"))
                .distinct().filter(F.col("code") != drop_code))

    @cached_property
    def _status_pairs(self) -> DataFrame:
        return self._decode_pairs(
            "lower(o_orderstatus)",
            "case o_orderstatus when 'O' then 'ON ORDER' when 'F' then 'FULLY PAID' else 'PARTLY PAID' end",
            "p")

    @cached_property
    def order_status_property(self) -> DataFrame:
        return self._status_pairs.select(F.ascii("code").cast("bigint").alias("id"), "code")

    @cached_property
    def order_status_property_name(self) -> DataFrame:
        return self._status_pairs.select(F.ascii("code").cast("bigint").alias("order_status_property_id"), "name")

    @cached_property
    def _form_pairs(self) -> DataFrame:
        return self._decode_pairs("substring(o_orderpriority, 1, 1)", "substring(o_orderpriority, 3)", "5")

    @cached_property
    def form_property(self) -> DataFrame:
        return self._form_pairs.select(F.ascii("code").cast("bigint").alias("id"), "code")

    @cached_property
    def form_property_name(self) -> DataFrame:
        return self._form_pairs.select(F.ascii("code").cast("bigint").alias("form_property_id"), "name")

    @cached_property
    def order_type_property_myuser(self) -> DataFrame:
        return self._decode_pairs("lower(substring(c_mktsegment, 1, 3))", "c_mktsegment", "hou")

    @cached_property
    def bib_record_order_record_link(self) -> DataFrame:
        return self.table("orders").select(
            (F.col("o_orderkey") + ORDER_OFFSET).alias("order_record_id"),
            (F.col("o_custkey") + BIB_OFFSET).alias("bib_record_id"),
            F.lit(0).alias("orders_display_order"))

    @cached_property
    def _line_rows(self) -> DataFrame:
        """lineitem ⋈ part with a per-order sequence number (cmf and receipt ids)."""
        order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
        levels = [F.col("l_linenumber"), F.floor(F.col("l_partkey") / 65536)]
        base = self._line_base.withColumn("order_record_id", F.col("l_orderkey") + ORDER_OFFSET)
        return row_number_chunked(base, ["order_record_id"], order, levels, "seq")

    @cached_property
    def order_record_cmf(self) -> DataFrame:
        return self._line_rows.select(
            (F.col("l_orderkey") * 100 + F.col("seq")).alias("id"),
            "order_record_id",
            F.col("l_linenumber").alias("display_order"),
            F.expr("case when p_type = 'PROMO' then 'none' else p_brand end").alias("fund_code"),
            F.expr("cast(l_quantity as int)").alias("copies"),
            F.expr("case when l_returnflag = 'A' and l_linestatus = 'F' then 'multi' "
                   "else lower(concat(l_returnflag, l_linestatus)) end").alias("location_code"),
        )

    @cached_property
    def order_record_received(self) -> DataFrame:
        return self._line_rows.filter(F.col("l_returnflag") == "R").select(
            (F.col("l_orderkey") * 100 + F.col("seq")).alias("id"),
            "order_record_id",
            F.expr(f"case when l_linenumber = 1 then cast(null as bigint) else l_partkey + {ITEM_OFFSET} end")
            .alias("item_record_metadata_id"),
            F.expr("lower(l_linestatus)").alias("location_code"),
            F.expr("regexp_replace(p_brand, '[^0-9]', '')").alias("fund_code"),
            F.col("l_linenumber").alias("copy_num"),
            F.lit(1).alias("volume_num"),
            F.lit(0).alias("display_order"),
            F.col("l_shipdate").alias("received_date_gmt"),
        )

    # ------------------------------------------------------------------ funds
    @cached_property
    def _fund_base(self) -> DataFrame:
        return (self.table("part")
                .withColumn("code_num", F.expr("cast(regexp_replace(p_brand, '[^0-9]', '') as int)"))
                .groupBy("code_num")
                .agg(F.expr("concat('brd', regexp_replace(min(p_brand), '[^0-9]', ''))").alias("fund_code"),
                     F.expr("cast(sum(cast(round(p_retailprice * 100) as bigint)) * 40 "
                            "* case when code_num % 6 = 0 then 0 else 1 end as bigint)").alias("appropriation"),
                     F.expr("cast(sum(cast(round(p_retailprice * 100) as bigint)) * 7 as bigint)")
                     .alias("expenditure"),
                     F.expr("cast(sum(cast(round(p_retailprice * 100) as bigint) * p_size) div 10 as bigint)")
                     .alias("encumbrance"),
                     F.count(F.lit(1)).cast("int").alias("n_parts"),
                     F.min("p_brand").alias("brand")))

    @cached_property
    def fund_master(self) -> DataFrame:
        return self._fund_base.select(
            F.col("code_num").cast("bigint").alias("id"),
            # every fund is in accounting unit 1; the key is read from the data
            # (1 + code_num div 1000) so the join stays a real equi-join
            F.expr("cast(1 + code_num div 1000 as bigint)").alias("accounting_unit_id"),
            "code_num", F.col("fund_code").alias("code"))

    @cached_property
    def accounting_unit(self) -> DataFrame:
        # the accounting units the funds belong to (all funds: unit 1)
        return self._fund_base.select(
            F.expr("cast(1 + code_num div 1000 as bigint)").alias("id"),
            F.expr("cast(1 + code_num div 1000 as int)").alias("code_num")).distinct()

    @cached_property
    def fund_myuser(self) -> DataFrame:
        cur = self._fund_base.select(
            F.col("code_num").cast("bigint").alias("fund_master_id"), F.lit("fbal").alias("fund_type"),
            "fund_code", F.col("code_num").alias("external_fund_code_num"),
            "appropriation", "expenditure", "encumbrance",
            F.col("n_parts").alias("num_orders"), F.expr("n_parts div 2").cast("int").alias("num_payments"),
            F.lit(90).alias("warning_percent"), F.lit(0).cast("decimal(18,6)").alias("discount_percent"),
            F.concat(F.lit("Fund "), F.col("code_num")).alias("name"),
            F.lit(None).cast("string").alias("note1"), F.lit(None).cast("string").alias("note2"))
        old = (cur.withColumn("fund_type", F.lit("oldfbal"))
               .withColumn("appropriation", F.expr("appropriation div 3"))
               .withColumn("expenditure", F.expr("expenditure div 3"))
               .withColumn("encumbrance", F.expr("encumbrance div 3")))
        return cur.unionByName(old)

    @cached_property
    def external_fund_property(self) -> DataFrame:
        return self._fund_base.select(F.col("code_num").cast("bigint").alias("id"), "code_num")

    @cached_property
    def external_fund_property_name(self) -> DataFrame:
        return (self._fund_base.filter(F.col("code_num") % 5 != 0)
                .select(F.col("code_num").cast("bigint").alias("external_fund_property_id"),
                        F.concat(F.lit("Ext "), F.col("brand")).alias("name")))

    @cached_property
    def fiscal_funds(self) -> DataFrame:
        """Fund to general-ledger mapping (the fiscal office CSV in production)."""
        base = self._fund_base.filter(F.col("code_num") != 24)
        main = base.select(
            F.col("code_num").alias("FiscalFundId"),
            F.concat(F.lit("Fund "), F.col("code_num")).alias("FundName"),
            F.upper("fund_code").alias("IlsFundCode"),
            F.col("code_num").alias("IlsFundCodeNumeric"),
            F.concat(F.lit("BRD "), F.col("code_num")).alias("IlsFundCodeSpaces"),
            F.expr("cast(8100000000 + code_num * 100 as bigint)").alias("GLKey"),
            F.expr("case code_num % 6 when 0 then 5410 when 1 then 5420 when 2 then 5430 "
                   "when 3 then 5450 when 4 then 5210 else 9999 end").alias("GLObj"))
        dup = (main.filter(F.col("IlsFundCodeNumeric").isin(1, 2))
               .withColumn("FiscalFundId", F.col("FiscalFundId") + 1000)
               .withColumn("IlsFundCode", F.lower("IlsFundCode")))
        return main.unionByName(dup)

    # ---------------------------------------------------------------- vendors
    @cached_property
    def vendor_record(self) -> DataFrame:
        return self.table("supplier").select(
            (F.col("s_suppkey") + VENDOR_OFFSET).alias("record_id"),
            F.concat(F.lit("v"), F.col("s_suppkey")).alias("code"),
            F.lit(1).alias("accounting_unit_code_num"))

    @cached_property
    def vendor_record_address(self) -> DataFrame:
        s = self.table("supplier").filter(F.col("s_suppkey") % 9 != 8)
        n = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        r = self.table("region").select("r_regionkey", "r_name")
        j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
        cols = lambda i, t, a1: [
            i.alias("id"), (F.col("s_suppkey") + VENDOR_OFFSET).alias("vendor_record_id"),
            F.lit(t).cast("bigint").alias("vendor_record_address_type_id"), F.lit(0).alias("display_order"),
            a1.alias("addr1"), F.lit(None).cast("string").alias("addr2"), F.lit(None).cast("string").alias("addr3"),
            F.lit(None).cast("string").alias("village"), F.col("n_name").alias("city"),
            F.col("r_name").alias("region"), F.lit(None).cast("string").alias("postal_code"),
            F.lit(None).cast("string").alias("country")]
        main = j.select(*cols(F.col("s_suppkey") * 10, 2, F.col("s_name")))
        hq = j.filter(F.col("s_suppkey") % 2 == 0).select(
            *cols(F.col("s_suppkey") * 10 + 1, 1, F.concat(F.lit("HQ "), F.col("s_name"))))
        return main.unionByName(hq)

    @cached_property
    def vendor_record_address_type(self) -> DataFrame:
        # the address types in use: 1 = 'a' (head office), 2 = 'b' (billing)
        return (self.vendor_record_address.select(F.col("vendor_record_address_type_id").alias("id")).distinct()
                .select("id", F.expr("case id when 1 then 'a' else 'b' end").alias("code")))

    @cached_property
    def fiscal_vendors(self) -> DataFrame:
        """Fiscal office vendor list (a CSV in production)."""
        return (self.table("supplier").filter("s_suppkey % 3 <> 0 and s_suppkey % 5 <> 0")
                .select(F.col("s_suppkey").cast("int").alias("FiscalVendorId"),
                        F.concat(F.lit("FV"), F.col("s_suppkey")).alias("FiscalVendorCode"),
                        F.col("s_name").alias("VendorName"),
                        F.concat(F.lit("v"), F.col("s_suppkey")).alias("IlsVendorCode")))

    # --------------------------------------------------------- variable fields
    @cached_property
    def varfield(self) -> DataFrame:
        s = self.table("supplier")
        vid = F.col("s_suppkey") + VENDOR_OFFSET
        first = s.select((vid * 10).alias("id"), vid.alias("record_id"),
                         F.expr("case s_suppkey % 3 when 0 then 'd' else 'z' end").alias("varfield_type_code"),
                         F.lit(0).alias("occ_num"),
                         F.concat(F.lit("P"), F.col("s_suppkey")).alias("field_content"))
        second = s.filter(F.col("s_suppkey") % 6 == 0).select(
            (vid * 10 + 1).alias("id"), vid.alias("record_id"), F.lit("d").alias("varfield_type_code"),
            F.lit(1).alias("occ_num"),
            F.expr("concat(case when s_suppkey % 12 = 0 then 'P' else 'Q' end, s_suppkey)").alias("field_content"))
        iid = F.col("p_partkey") + ITEM_OFFSET
        barcodes = self.table("part").select(
            (iid * 10).alias("id"), iid.alias("record_id"), F.lit("b").alias("varfield_type_code"),
            F.lit(0).alias("occ_num"), F.concat(F.lit("a"), F.col("p_partkey")).alias("field_content"))
        return first.unionByName(second).unionByName(barcodes)

    # ------------------------------------------------------- record metadata
    @cached_property
    def record_metadata(self) -> DataFrame:
        def kind(df: DataFrame, key: str, offset: int, code: str, stored: bool = False) -> DataFrame:
            # ``stored``: the column holds the record id, not the base key
            rid, key = (F.col(key), F.col(key) - offset) if stored else (F.col(key) + offset, F.col(key))
            return df.select(
                rid.alias("id"),
                (key + RECORD_NUM_BASE).alias("record_num"),
                F.lit(code).alias("record_type_code"),
                F.lit(CREATED_GMT).cast("timestamp_ntz").alias("creation_date_gmt"),
                F.lit(UPDATED_GMT).cast("timestamp_ntz").alias("record_last_updated_gmt"),
                (key % 7).cast("int").alias("num_revisions"))
        inv = (self._invoice_totals.select("invoice_record_id")
               .unionByName(self.table("supplier").select((F.col("s_suppkey") * 1000 + (999 + INVOICE_OFFSET)).alias("invoice_record_id"))))
        return (kind(inv, "invoice_record_id", INVOICE_OFFSET, "n", stored=True)
                .unionByName(kind(self.table("orders"), "o_orderkey", ORDER_OFFSET, "o"))
                .unionByName(kind(self.table("supplier"), "s_suppkey", VENDOR_OFFSET, "v"))
                .unionByName(kind(self.table("part"), "p_partkey", ITEM_OFFSET, "i"))
                .unionByName(kind(self.table("customer"), "c_custkey", BIB_OFFSET, "b")))

    # ------------------------------------------------------------ code tables
    @cached_property
    def record_type(self) -> DataFrame:
        codes = self.record_metadata.select(F.col("record_type_code").alias("code")).distinct()
        return codes.select(F.ascii("code").cast("bigint").alias("id"), "code")

    @cached_property
    def record_type_name(self) -> DataFrame:
        return self.record_type.select(
            F.col("id").alias("record_type_id"),
            F.expr("case code when 'n' then 'INVOICE' when 'o' then 'ORDER' when 'v' then 'VENDOR' "
                   "when 'i' then 'ITEM' else 'BIBLIOGRAPHIC' end").alias("name"))

    @cached_property
    def _varfield_types(self) -> DataFrame:
        vf = self.varfield.select("record_id", "varfield_type_code")
        rm = self.record_metadata.select(F.col("id").alias("record_id"), "record_type_code")
        return vf.join(rm, "record_id").select("record_type_code", "varfield_type_code").distinct()

    @cached_property
    def varfield_type(self) -> DataFrame:
        return self._varfield_types.select(
            (F.ascii("record_type_code") * 1000 + F.ascii("varfield_type_code")).cast("bigint").alias("id"),
            "record_type_code", F.col("varfield_type_code").alias("code"),
            (F.col("varfield_type_code") != "z").alias("is_enabled"),
            F.ascii("varfield_type_code").alias("display_order"))

    @cached_property
    def varfield_type_name(self) -> DataFrame:
        return self._varfield_types.select(
            (F.ascii("record_type_code") * 1000 + F.ascii("varfield_type_code")).cast("bigint")
            .alias("varfield_type_id"),
            F.upper("varfield_type_code").alias("short_name"),
            F.expr("case varfield_type_code when 'b' then 'Barcode' when 'd' then 'Alternate Code' "
                   "else 'Special' end").alias("name"))
