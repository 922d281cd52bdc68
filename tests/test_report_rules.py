"""Rules of the reports on literal rows: payee id (T11), duplicate removal of
the ledger view (V9), summary fund children (T4), fund repetition (Q2)."""

import datetime as dt
from decimal import Decimal

from fakes import FakeSources

from procura.plans import queries as Q
from procura.plans.marts import Marts
from procura.plans.reports import Reports

VO = 30_000_000_000
IO = 10_000_000_000
OO = 20_000_000_000
TS = dt.datetime(2020, 1, 1)


def _rm(i, num, code):
    return {"id": i, "record_num": num, "record_type_code": code, "creation_date_gmt": TS,
            "record_last_updated_gmt": TS, "num_revisions": 0}


def _vendor_sources(spark, small_dir):
    vendors = {1: "only z, no fiscal", 2: "only z, fiscal", 3: "two d", 4: "d and z"}
    vr = [{"record_id": VO + k, "code": f"v{k}", "accounting_unit_code_num": 1} for k in vendors]
    vra = [{"id": k * 10, "vendor_record_id": VO + k, "vendor_record_address_type_id": 2, "display_order": 0,
            "addr1": f"Name {k}"} for k in vendors]
    vf = [{"id": 1, "record_id": VO + 1, "varfield_type_code": "z", "occ_num": 0, "field_content": "Z1"},
          {"id": 2, "record_id": VO + 2, "varfield_type_code": "z", "occ_num": 0, "field_content": "Z2"},
          {"id": 3, "record_id": VO + 3, "varfield_type_code": "d", "occ_num": 1, "field_content": "D3b"},
          {"id": 4, "record_id": VO + 3, "varfield_type_code": "d", "occ_num": 0, "field_content": "D3a"},
          {"id": 5, "record_id": VO + 4, "varfield_type_code": "z", "occ_num": 0, "field_content": "Z4"},
          {"id": 6, "record_id": VO + 4, "varfield_type_code": "d", "occ_num": 3, "field_content": "D4"}]
    fv = [{"FiscalVendorId": 2, "FiscalVendorCode": "FV2", "VendorName": "n", "IlsVendorCode": "v2"},
          {"FiscalVendorId": 3, "FiscalVendorCode": "FV3", "VendorName": "n", "IlsVendorCode": "v3"}]
    inv = [{"id": IO + k, "record_id": IO + k, "invoice_number_text": f"00{k}", "subtotal_amt": Decimal("1.00"),
            "grand_total_amt": Decimal("1.00"), "invoice_date_gmt": TS} for k in vendors]
    lines = [{"id": k, "invoice_record_id": IO + k, "line_cnt": 0, "paid_amt": Decimal("1.00"),
              "vendor_code": f" v{k} " if k % 2 else f"v{k}"} for k in vendors]
    rm = ([_rm(VO + k, 100 + k, "v") for k in vendors] + [_rm(IO + k, 200 + k, "n") for k in vendors])
    return FakeSources(spark, small_dir, vendor_record=vr, vendor_record_address=vra,
                       vendor_record_address_type=[(1, "a"), (2, "b")], varfield=vf, fiscal_vendors=fv,
                       invoice_record=inv, invoice_record_line=lines, record_metadata=rm)


def test_payee_rule(spark, small_dir):
    r = Reports(Marts(_vendor_sources(spark, small_dir), materialize="none"))
    got = {row.invoice_record_id - IO: row.peid for row in r.peid_view.collect()}
    # z fields never give a payee; 'd' wins with the lowest occurrence; else fiscal code
    assert got == {1: None, 2: "FV2", 3: "D3a", 4: "D4"}


def _ledger_sources(spark, small_dir):
    fm = [{"id": 1, "accounting_unit_id": 1, "code_num": 1, "code": "brd1"}]
    fmu = [{"fund_master_id": 1, "fund_type": "fbal", "fund_code": "brd1", "external_fund_code_num": 1,
            "appropriation": 100, "expenditure": 1, "encumbrance": 1}]
    ff = [{"FiscalFundId": 1, "IlsFundCode": "BRD1", "GLKey": 8100000100, "GLObj": 5410},
          {"FiscalFundId": 2, "IlsFundCode": "brd1", "GLKey": 8100000100, "GLObj": 5410}]
    inv = [{"id": IO + 1, "record_id": IO + 1, "invoice_number_text": "0001", "subtotal_amt": Decimal("3.00"),
            "grand_total_amt": Decimal("3.10"), "invoice_date_gmt": TS, "posted_data_gmt": TS}]
    lines = [{"id": i, "invoice_record_id": IO + 1, "line_cnt": i, "paid_amt": Decimal("1.00"), "fund_code": "1",
              "vendor_code": "v9"} for i in range(3)]
    rm = [_rm(IO + 1, 201, "n")]
    return FakeSources(spark, small_dir, fund_master=fm, accounting_unit=[(1, 1)], fund_myuser=fmu,
                       fiscal_funds=ff, invoice_record=inv, invoice_record_line=lines, record_metadata=rm)


def test_ledger_duplicates_removed_by_distinct_view(spark, small_dir):
    r = Reports(Marts(_ledger_sources(spark, small_dir), materialize="none"))
    full = r.ledger_export_table.collect()
    distinct = r.ledger_export_view.collect()
    # two GL rows share the code case-insensitively: every detail row doubles
    assert sum(1 for x in full if x.row_type == "D") == 6
    assert sum(1 for x in distinct if x.row_type == "D") == 3
    d = sorted((x.invoice_total_or_sequence, x.net_amount) for x in distinct if x.row_type == "D")
    # 1.00 + 3 cents share each, last line carries the 1 cent residual
    assert d == [(Decimal("1.00"), Decimal("1.03")), (Decimal("2.00"), Decimal("1.03")),
                 (Decimal("3.00"), Decimal("1.04"))]
    h = [x for x in distinct if x.row_type == "H"][0]
    assert h.net_amount == Decimal("3.10") and h.invoice_date_or_org == "01/01/2020"
    assert h.invoice_number == "1"


def _order_sources(spark, small_dir):
    orr = [{"record_id": OO + k, "order_status_code": "o", "estimated_price": Decimal("1.00")} for k in (1, 2)]
    cmf = [{"id": 1, "order_record_id": OO + 1, "display_order": 0, "fund_code": "Brand#1", "copies": 1,
            "location_code": "multi"},
           {"id": 2, "order_record_id": OO + 2, "display_order": 0, "fund_code": "Brand#1", "copies": 1,
            "location_code": "ao"},
           {"id": 3, "order_record_id": OO + 2, "display_order": 1, "fund_code": "Brand#1", "copies": 2,
            "location_code": "ao"}]
    fm = [{"id": 1, "accounting_unit_id": 1, "code_num": 1, "code": "brd1"}]
    rm = [_rm(OO + k, 300 + k, "o") for k in (1, 2)]
    return FakeSources(spark, small_dir, order_record=orr, order_record_cmf=cmf, fund_master=fm,
                       accounting_unit=[(1, 1)], record_metadata=rm)


def test_order_with_only_summary_children_is_absent(spark, small_dir):
    m = Marts(_order_sources(spark, small_dir), materialize="none")
    rows = m.orders.collect()
    assert [r.order_record_num for r in rows] == [302]
    assert rows[0].count_cmf == 2 and rows[0].count_distinct_cmf_fund_codes == 1 and rows[0].sum_cmf_copies == 3
    assert len(rows[0].cmf_data) == rows[0].count_cmf


def test_on_order_by_fund_repeats_per_child(spark, small_dir):
    m = Marts(_order_sources(spark, small_dir), materialize="none")
    assert [r.order_record_num for r in Q.on_order_by_fund(m, "brd1").collect()] == [302, 302]
