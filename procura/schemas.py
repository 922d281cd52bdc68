"""Declared schemas of the marts (names and types; nullability is not part
of the contract).  ``tests/test_schemas_sql.py`` asserts every mart conforms, and
:func:`procura.sources.sinks.conform` casts a frame to one of them."""

from __future__ import annotations

from pyspark.sql.types import StructType

MART_DDL = {
    "varfield_metadata": (
        "record_type_name STRING,record_type_code STRING,varfield_code STRING,"
        "varfield_is_enabled BOOLEAN,varfield_display_order INT,varfield_type_short_name STRING,"
        "varfield_type_name STRING"
    ),
    "varfield": (
        "record_id BIGINT,record_num BIGINT,record_type_code STRING,varfield_id BIGINT,"
        "varfield_type_code STRING,occ_num INT,field_content STRING"
    ),
    "fund": (
        "fund_master_id BIGINT,accounting_unit_code_num INT,fund_code_num INT,fund_master_code STRING,"
        "fund_type STRING,fund_code STRING,external_fund_code_num INT,external_fund_name STRING,"
        "appropriation BIGINT,expenditure BIGINT,encumbrance BIGINT,num_orders INT,num_payments INT,"
        "warning_percent INT,discount_percent DECIMAL(18,6),name STRING,note1 STRING,note2 STRING"
    ),
    "invoice": (
        "invoice_record_id BIGINT,invoice_record_num BIGINT,invoice_number_text STRING,"
        "count_invoice_record_line BIGINT,json_invoice_record_line ARRAY<STRUCT<line_cnt: INT,"
        " order_record_id: BIGINT, order_record_num: BIGINT, title: STRING, paid_amt_cents: BIGINT,"
        " lien_amt_cents: BIGINT, lien_flag: STRING, list_price_cents: BIGINT, fund_code: STRING,"
        " subfund_num: INT, copies_paid_cnt: INT, external_fund_code_num: INT, status_code: STRING,"
        " note: STRING, is_single_copy_partial_pmt: BOOLEAN, multiflag_code: STRING,"
        " line_level_tax_cents: BIGINT, vendor_code: STRING, accounting_transaction_voucher_num: BIGINT,"
        " accounting_transaction_voucher_seq_num: INT, invoice_record_vendor_summary_id: BIGINT,"
        " is_use_tax: BOOLEAN, approx_adjust_amt: BIGINT>>,creation_date DATE,last_updated DATE,"
        "accounting_unit_code_num INT,invoice_date DATE,paid_date DATE,invoice_record_status_code STRING,"
        "posted_date DATE,is_paid_date_received_date BOOLEAN,staff_user_name STRING,"
        "foreign_currency_code STRING,foreign_currency_format STRING,"
        "foreign_currency_exchange_rate DECIMAL(18,6),tax_fund_code STRING,tax_type_code STRING,"
        "discount_amt_cents BIGINT,grand_total_amt_cents BIGINT,subtotal_amt_cents BIGINT,"
        "shipping_amt_cents BIGINT,total_tax_amt_cents BIGINT,use_tax_fund_code STRING,"
        "use_tax_percentage_rate DECIMAL(18,6),use_tax_type_code STRING,use_tax_ship_service_code STRING,"
        "is_suppressed BOOLEAN"
    ),
    "invoice_line_data": (
        "invoice_record_id BIGINT,invoice_record_num BIGINT,line_cnt INT,total_lines BIGINT,"
        "paid_amt_cents BIGINT,grand_total_amt_cents BIGINT,subtotal_amt_cents BIGINT,"
        "approx_adj_amt BIGINT,running_adjusted_total_paid_cents BIGINT,is_off BOOLEAN,"
        "off_amt_cents BIGINT"
    ),
    "invoice_record_order_record_link": (
        "invoice_record_id BIGINT,invoice_record_num BIGINT,order_record_id BIGINT,"
        "order_record_num BIGINT"
    ),
    "invoice_record_vendor_record_link": (
        "invoice_record_id BIGINT,invoice_record_num BIGINT,vendor_record_id BIGINT,"
        "vendor_record_num BIGINT,vendor_code STRING,voucher_num INT,voucher_total BIGINT,"
        "display_order INT"
    ),
    "orders": (
        "order_record_num BIGINT,order_record_id BIGINT,count_cmf BIGINT,"
        "count_distinct_cmf_fund_codes BIGINT,sum_cmf_copies BIGINT,"
        "cmf_data ARRAY<STRUCT<display_order: INT, cmf_id: BIGINT, fund_code_num: INT, fund_code: STRING,"
        " acct_unit_code_num: INT, copies: INT, location_code: STRING>>,orders_display_order INT,"
        "bib_record_id BIGINT,bib_record_num BIGINT,creation_date_gmt TIMESTAMP_NTZ,"
        "accounting_unit_code_num INT,estimated_price_cents BIGINT,physical_form_code STRING,"
        "physical_form_name STRING,order_date_gmt TIMESTAMP_NTZ,catalog_date_gmt TIMESTAMP_NTZ,"
        "order_type_code STRING,order_type_name STRING,received_date_gmt TIMESTAMP_NTZ,"
        "receiving_location_code STRING,order_status_code STRING,order_status_name STRING,"
        "vendor_record_code STRING,vendor_record_id BIGINT,volume_count INT"
    ),
    "vendors": (
        "vendor_record_id BIGINT,vendor_record_num BIGINT,record_create_date DATE,"
        "record_last_updated DATE,num_revisions INT,vendor_name STRING,vendor_record_code STRING,"
        "accounting_unit_code_num INT,count_address BIGINT,"
        "vendor_record_address ARRAY<STRUCT<address_type_code: STRING, display_order: INT, addr1: STRING,"
        " addr2: STRING, addr3: STRING, village: STRING, city: STRING, region: STRING,"
        " postal_code: STRING, country: STRING, vendor_record_address_id: BIGINT>>"
    ),
    "invoice_record_vendor_summary": (
        "invoice_record_vendor_summary_id BIGINT,invoice_number_text STRING,invoice_record_id BIGINT,"
        "invoice_record_num BIGINT,vendor_code STRING,voucher_num INT,voucher_total_cents BIGINT,"
        "display_order INT,invoice_date DATE"
    ),
    "order_record_received": (
        "order_record_received_id BIGINT,order_record_id BIGINT,order_record_num BIGINT,"
        "location_code STRING,fund_code STRING,copy_num INT,volume_num INT,item_record_id BIGINT,"
        "item_record_num BIGINT,existing_item_barcode STRING,received_date DATE,display_order INT"
    ),
}


def mart_schema(name: str) -> StructType:
    return StructType.fromDDL(MART_DDL[name])
