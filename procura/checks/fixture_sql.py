"""The test-table mapping of FIXTURES.md section 3 as DuckDB SQL.

Independent oracle side: the same source relations as
:mod:`procura.sources.testdata`, written as common table expressions over the
driver's views (``lineitem``, ``orders``, ...).  :func:`with_sources` prefixes
a query with the CTEs it needs.
"""

from __future__ import annotations

import re

IO, OO, VO, TO, BO = (kind << 56 for kind in (1, 2, 3, 4, 5))

CTES: dict[str, str] = {}

CTES["src_line_base"] = """
  select l.*, p.p_name, p.p_brand, p.p_type, p.p_retailprice,
         case when l_linenumber = 7 and l_orderkey < 10000 then 501
              else l_suppkey * 1000 + (year(l_shipdate) - 1990) * 12 + month(l_shipdate) end as ik,
         cast(round(l_extendedprice * 100) as bigint) as paid_cents,
         cast(round(l_discount * 100) as bigint) as disc100,
         cast(round(l_tax * 100) as bigint) as tax100,
         (cast(round(l_extendedprice * 100) as bigint) * (100 - cast(round(l_discount * 100) as bigint))
           * (100 + cast(round(l_tax * 100) as bigint)) + 5000) // 10000 as charged_cents
  from lineitem l join part p on p.p_partkey = l.l_partkey"""

CTES["src_lines"] = """
  select *, cast(case when pos % 89 = 88 then null when pos % 13 = 12 then pos - 1 else pos end as integer) as line_cnt
  from (select *, row_number() over (partition by ik order by l_shipdate, l_orderkey, l_linenumber, l_partkey,
          l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) - 1 as pos
        from src_line_base) x"""

CTES["invoice_record_line"] = f"""
  select ik * 4194304 + pos as id, ik + {IO} as invoice_record_id, line_cnt,
    case when l_returnflag = 'R' and l_linestatus = 'F' then null else l_orderkey + {OO} end
      as order_record_metadata_id,
    p_name as title,
    cast(cast(paid_cents as decimal(12,0)) / 100 as decimal(12,2)) as paid_amt,
    cast(cast((paid_cents * disc100) // 100 as decimal(12,0)) / 100 as decimal(12,2)) as lien_amt,
    l_returnflag as lien_flag,
    cast(cast(cast(round(p_retailprice * 100) as bigint) as decimal(12,0)) / 100 as decimal(12,2)) as list_price,
    case when p_type = 'PROMO' then 'none' else regexp_replace(p_brand, '[^0-9]', '', 'g') end as fund_code,
    cast(l_linenumber % 3 as integer) as subfund_num,
    cast(l_quantity as integer) as copies_paid_cnt,
    case when p_type = 'PROMO' then null
         else cast(regexp_replace(p_brand, '[^0-9]', '', 'g') as integer) end as external_fund_code_num,
    l_linestatus as status_code, cast(null as varchar) as note,
    l_quantity < 2 as is_single_copy_partial_pmt, l_returnflag as multiflag_code,
    cast(cast((paid_cents * tax100) // 100 as decimal(12,0)) / 100 as decimal(12,2)) as line_level_tax,
    case when l_suppkey % 4 = 0 then concat(' v', l_suppkey, ' ') else concat('v', l_suppkey) end as vendor_code,
    ik as accounting_transaction_voucher_num, line_cnt + 1 as accounting_transaction_voucher_seq_num,
    ik + {IO} as invoice_record_vendor_summary_id, tax100 > 5 as is_use_tax
  from src_lines"""

CTES["src_invoice_totals"] = """
  select ik, cast(sum(paid_cents) as bigint) as sub_c, cast(sum(charged_cents) as bigint) as grand_c,
         cast(sum((paid_cents * disc100) // 100) as bigint) as disc_c,
         cast(sum((paid_cents * tax100) // 100) as bigint) as tax_c,
         min(cast(l_shipdate as date)) as first_d, max(cast(l_shipdate as date)) as last_d
  from src_lines group by ik
  union all
  select s_suppkey * 1000 + 999, 0, 0, 0, 0, date '2001-01-01', date '2001-01-01' from supplier"""

CTES["invoice_record"] = f"""
  select ik + {IO} as id, ik + {IO} as record_id,
    case ik % 4 when 0 then concat('000', ik) when 1 then concat('00', ik, 'CO') when 2 then '0000'
         else concat('0', ik) end as invoice_number_text,
    case when ik % 5 = 0 then 'a' else 'p' end as status_code,
    1 as accounting_unit_code_num,
    cast(first_d as timestamp) as invoice_date_gmt,
    case when ik % 7 = 0 then null else cast(last_d as timestamp) end as paid_date_gmt,
    case when ik % 5 = 0 then null else cast(last_d as timestamp) end as posted_data_gmt,
    ik % 2 = 0 as is_paid_date_received_date,
    concat('user', ik % 10) as staff_user_name, 'USD' as foreign_currency_code,
    cast(null as varchar) as foreign_currency_format, cast(1 as decimal(18,6)) as foreign_currency_exchange_rate,
    cast(null as varchar) as tax_fund_code, cast(null as varchar) as tax_type_code,
    cast(cast(disc_c as decimal(14,0)) / 100 as decimal(14,2)) as discount_amt,
    cast(cast(grand_c as decimal(14,0)) / 100 as decimal(14,2)) as grand_total_amt,
    cast(cast(sub_c as decimal(14,0)) / 100 as decimal(14,2)) as subtotal_amt,
    cast(0 as decimal(14,2)) as shipping_amt,
    cast(cast(tax_c as decimal(14,0)) / 100 as decimal(14,2)) as total_tax_amt,
    cast(null as varchar) as use_tax_fund_code, cast(null as decimal(18,6)) as use_tax_percentage_rate,
    cast(null as varchar) as use_tax_type_code, cast(null as varchar) as use_tax_ship_service_code,
    false as is_suppressed
  from src_invoice_totals"""

CTES["invoice_record_vendor_summary"] = f"""
  select ik + {IO} as id, ik + {IO} as invoice_record_id, trim(vc) as vendor_code,
         cast(min(line_cnt) as integer) as voucher_num, cast(sum(charged_cents) as bigint) as voucher_total,
         0 as display_order
  from (select *, case when l_suppkey % 4 = 0 then concat(' v', l_suppkey, ' ') else concat('v', l_suppkey) end
          as vc from src_lines) x
  group by ik, vc"""

CTES["src_orders"] = """
  select o.*, c.c_mktsegment from orders o join customer c on c.c_custkey = o.o_custkey"""

CTES["order_record"] = f"""
  select o_orderkey + {OO} as record_id, 1 as accounting_unit_code_num,
    cast(cast(cast(round(o_totalprice * 100) as bigint) as decimal(12,0)) / 100 as decimal(12,2))
      as estimated_price,
    substring(o_orderpriority, 1, 1) as form_code,
    lower(substring(c_mktsegment, 1, 3)) as order_type_code,
    concat('rl', o_orderkey % 4) as receiving_location_code,
    lower(o_orderstatus) as order_status_code,
    concat('v', o_orderkey % 10) as vendor_record_code,
    case when o_orderkey % 11 = 5 then null else o_orderdate end as order_date_gmt,
    case when o_orderstatus = 'O' then null else o_orderdate end as catalog_date_gmt,
    case when o_orderstatus = 'F' then o_orderdate + interval 30 days else null end as received_date_gmt,
    cast(o_orderkey % 3 as integer) as volume_count
  from src_orders"""

CTES["order_status_property"] = """
  select distinct cast(ascii(lower(o_orderstatus)) as bigint) as id, lower(o_orderstatus) as code
  from orders where lower(o_orderstatus) <> 'p'"""
CTES["order_status_property_name"] = """
  select distinct cast(ascii(lower(o_orderstatus)) as bigint) as order_status_property_id,
    case o_orderstatus when 'O' then 'ON ORDER' when 'F' then 'FULLY PAID' else 'PARTLY PAID' end as name
  from orders where lower(o_orderstatus) <> 'p'"""
CTES["form_property"] = """
  select distinct cast(ascii(substring(o_orderpriority, 1, 1)) as bigint) as id,
    substring(o_orderpriority, 1, 1) as code
  from orders where substring(o_orderpriority, 1, 1) <> '5'"""
CTES["form_property_name"] = """
  select distinct cast(ascii(substring(o_orderpriority, 1, 1)) as bigint) as form_property_id,
    substring(o_orderpriority, 3) as name
  from orders where substring(o_orderpriority, 1, 1) <> '5'"""
CTES["order_type_property_myuser"] = """
  select distinct lower(substring(c_mktsegment, 1, 3)) as code, c_mktsegment as name
  from src_orders where lower(substring(c_mktsegment, 1, 3)) <> 'hou'"""

CTES["bib_record_order_record_link"] = f"""
  select o_orderkey + {OO} as order_record_id, o_custkey + {BO} as bib_record_id, 0 as orders_display_order
  from orders"""

CTES["src_line_rows"] = """
  select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_shipdate,
         l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) as seq
  from src_line_base"""

CTES["order_record_cmf"] = f"""
  select l_orderkey * 100 + seq as id, l_orderkey + {OO} as order_record_id, l_linenumber as display_order,
    case when p_type = 'PROMO' then 'none' else p_brand end as fund_code,
    cast(l_quantity as integer) as copies,
    case when l_returnflag = 'A' and l_linestatus = 'F' then 'multi'
         else lower(concat(l_returnflag, l_linestatus)) end as location_code
  from src_line_rows"""

CTES["order_record_received"] = f"""
  select l_orderkey * 100 + seq as id, l_orderkey + {OO} as order_record_id,
    case when l_linenumber = 1 then null else l_partkey + {TO} end as item_record_metadata_id,
    lower(l_linestatus) as location_code, regexp_replace(p_brand, '[^0-9]', '', 'g') as fund_code,
    l_linenumber as copy_num, 1 as volume_num, 0 as display_order, l_shipdate as received_date_gmt
  from src_line_rows where l_returnflag = 'R'"""

CTES["src_fund_base"] = """
  select cast(regexp_replace(p_brand, '[^0-9]', '', 'g') as integer) as code_num,
    concat('brd', regexp_replace(min(p_brand), '[^0-9]', '', 'g')) as fund_code,
    cast(sum(cast(round(p_retailprice * 100) as bigint)) * 40
      * case when cast(regexp_replace(p_brand, '[^0-9]', '', 'g') as integer) % 6 = 0 then 0 else 1 end
      as bigint) as appropriation,
    cast(sum(cast(round(p_retailprice * 100) as bigint)) * 7 as bigint) as expenditure,
    cast(sum(cast(round(p_retailprice * 100) as bigint) * p_size) // 10 as bigint) as encumbrance,
    cast(count(*) as integer) as n_parts, min(p_brand) as brand
  from part group by 1"""

CTES["fund_master"] = """
  select cast(code_num as bigint) as id, cast(1 + code_num // 1000 as bigint) as accounting_unit_id, code_num,
    fund_code as code
  from src_fund_base"""
CTES["accounting_unit"] = """
  select distinct cast(1 + code_num // 1000 as bigint) as id, cast(1 + code_num // 1000 as integer) as code_num
  from src_fund_base"""
CTES["fund_myuser"] = """
  select cast(code_num as bigint) as fund_master_id, 'fbal' as fund_type, fund_code,
    code_num as external_fund_code_num, appropriation, expenditure, encumbrance,
    n_parts as num_orders, cast(n_parts // 2 as integer) as num_payments, 90 as warning_percent,
    cast(0 as decimal(18,6)) as discount_percent, concat('Fund ', code_num) as name,
    cast(null as varchar) as note1, cast(null as varchar) as note2
  from src_fund_base
  union all
  select cast(code_num as bigint), 'oldfbal', fund_code, code_num, appropriation // 3, expenditure // 3,
    encumbrance // 3, n_parts, cast(n_parts // 2 as integer), 90, cast(0 as decimal(18,6)),
    concat('Fund ', code_num), null, null
  from src_fund_base"""
CTES["external_fund_property"] = "select cast(code_num as bigint) as id, code_num from src_fund_base"
CTES["external_fund_property_name"] = """
  select cast(code_num as bigint) as external_fund_property_id, concat('Ext ', brand) as name
  from src_fund_base where code_num % 5 <> 0"""
CTES["fiscal_funds"] = """
  select code_num as FiscalFundId, concat('Fund ', code_num) as FundName, upper(fund_code) as IlsFundCode,
    code_num as IlsFundCodeNumeric, concat('BRD ', code_num) as IlsFundCodeSpaces,
    cast(8100000000 + code_num * 100 as bigint) as GLKey,
    case code_num % 6 when 0 then 5410 when 1 then 5420 when 2 then 5430 when 3 then 5450
         when 4 then 5210 else 9999 end as GLObj
  from src_fund_base where code_num <> 24
  union all
  select code_num + 1000, concat('Fund ', code_num), lower(fund_code), code_num, concat('BRD ', code_num),
    cast(8100000000 + code_num * 100 as bigint),
    case code_num % 6 when 0 then 5410 when 1 then 5420 when 2 then 5430 when 3 then 5450
         when 4 then 5210 else 9999 end
  from src_fund_base where code_num in (1, 2)"""

CTES["vendor_record"] = f"""
  select s_suppkey + {VO} as record_id, concat('v', s_suppkey) as code, 1 as accounting_unit_code_num
  from supplier"""
CTES["vendor_record_address"] = f"""
  select s_suppkey * 10 as id, s_suppkey + {VO} as vendor_record_id, cast(2 as bigint)
      as vendor_record_address_type_id, 0 as display_order, s_name as addr1, cast(null as varchar) as addr2,
    cast(null as varchar) as addr3, cast(null as varchar) as village, n_name as city, r_name as region,
    cast(null as varchar) as postal_code, cast(null as varchar) as country
  from supplier join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey
  where s_suppkey % 9 <> 8
  union all
  select s_suppkey * 10 + 1, s_suppkey + {VO}, cast(1 as bigint), 0, concat('HQ ', s_name), null, null, null,
    n_name, r_name, null, null
  from supplier join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey
  where s_suppkey % 9 <> 8 and s_suppkey % 2 = 0"""
CTES["vendor_record_address_type"] = """
  select distinct vendor_record_address_type_id as id,
    case vendor_record_address_type_id when 1 then 'a' else 'b' end as code
  from vendor_record_address"""
CTES["fiscal_vendors"] = """
  select cast(s_suppkey as integer) as FiscalVendorId, concat('FV', s_suppkey) as FiscalVendorCode,
    s_name as VendorName, concat('v', s_suppkey) as IlsVendorCode
  from supplier where s_suppkey % 3 <> 0 and s_suppkey % 5 <> 0"""

CTES["varfield"] = f"""
  select (s_suppkey + {VO}) * 10 as id, s_suppkey + {VO} as record_id,
    case s_suppkey % 3 when 0 then 'd' else 'z' end as varfield_type_code, 0 as occ_num,
    concat('P', s_suppkey) as field_content
  from supplier
  union all
  select (s_suppkey + {VO}) * 10 + 1, s_suppkey + {VO}, 'd', 1,
    concat(case when s_suppkey % 12 = 0 then 'P' else 'Q' end, s_suppkey)
  from supplier where s_suppkey % 6 = 0
  union all
  select (p_partkey + {TO}) * 10, p_partkey + {TO}, 'b', 0, concat('a', p_partkey) from part"""

CTES["record_metadata"] = f"""
  select id, record_num, record_type_code,
    timestamp '2020-01-01 00:00:00' as creation_date_gmt,
    timestamp '2020-06-01 12:00:00' as record_last_updated_gmt, num_revisions
  from (
    select ik + {IO} as id, ik + 1000000 as record_num, 'n' as record_type_code,
           cast(ik % 7 as integer) as num_revisions from src_invoice_totals
    union all select o_orderkey + {OO}, o_orderkey + 1000000, 'o', cast(o_orderkey % 7 as integer) from orders
    union all select s_suppkey + {VO}, s_suppkey + 1000000, 'v', cast(s_suppkey % 7 as integer) from supplier
    union all select p_partkey + {TO}, p_partkey + 1000000, 'i', cast(p_partkey % 7 as integer) from part
    union all select c_custkey + {BO}, c_custkey + 1000000, 'b', cast(c_custkey % 7 as integer) from customer
  ) k"""

CTES["record_type"] = """
  select distinct cast(ascii(record_type_code) as bigint) as id, record_type_code as code from record_metadata"""
CTES["record_type_name"] = """
  select id as record_type_id,
    case code when 'n' then 'INVOICE' when 'o' then 'ORDER' when 'v' then 'VENDOR' when 'i' then 'ITEM'
         else 'BIBLIOGRAPHIC' end as name
  from record_type"""
CTES["src_varfield_types"] = """
  select distinct rm.record_type_code, v.varfield_type_code
  from varfield v join record_metadata rm on rm.id = v.record_id"""
CTES["varfield_type"] = """
  select cast(ascii(record_type_code) * 1000 + ascii(varfield_type_code) as bigint) as id, record_type_code,
    varfield_type_code as code, varfield_type_code <> 'z' as is_enabled, ascii(varfield_type_code) as display_order
  from src_varfield_types"""
CTES["varfield_type_name"] = """
  select cast(ascii(record_type_code) * 1000 + ascii(varfield_type_code) as bigint) as varfield_type_id,
    upper(varfield_type_code) as short_name,
    case varfield_type_code when 'b' then 'Barcode' when 'd' then 'Alternate Code' else 'Special' end as name
  from src_varfield_types"""

_NAME = re.compile(r"\b([a-z_]+)\b")


def _deps(name: str) -> list[str]:
    body = CTES[name]
    return [t for t in dict.fromkeys(_NAME.findall(body)) if t in CTES and t != name]


def with_sources(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs (source relations and ``extra`` named
    sub-queries, in the given order) it references, dependencies first."""
    extra = extra or {}
    defs = {**CTES, **extra}
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in [t for t in dict.fromkeys(_NAME.findall(defs[n])) if t in defs and t != n]:
            visit(d)
        order.append(n)

    for n in dict.fromkeys(_NAME.findall(sql)):
        if n in defs:
            visit(n)
    if not order:
        return sql
    return "with " + ",\n".join(f"{n} as ({defs[n]}\n)" for n in order) + "\n" + sql
