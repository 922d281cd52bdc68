"""S1/S2 CSV layouts, S4-S8 round trips, and the full refresh end to end."""

import os

import pytest
from pyspark.sql import functions as F

from procura.plans import queries as Q
from procura.plans.ledger_store import LEDGER_TABLES
from procura.plans.marts import Marts
from procura.plans.refresh import FISCAL_NAMES, MART_NAMES, REPORT_NAMES, main, refresh
from procura.plans.registry import QUERIES
from procura.plans.reports import ALT_LEDGER_HEADERS, LEDGER_HEADERS
from procura.sources.catalog import SourceCatalog
from procura.sources.files import FISCAL_FUND_COLUMNS, read_fiscal_funds, read_fiscal_vendors, rejected_values
from procura.sources.sinks import (conform, current_snapshot, export_csv, open_snapshot, publish_snapshot, read_current,
                                   write_table)
from procura.sources.testdata import TestSources

FUNDS_QUOTED_LF = ('"rowid","FiscalFundId","FundName","IlsFundCode","IlsFundCodeNumeric",'
                   '"IlsFundCodeSpaces","GLKey","GLObj"\n'
                   '1,1,"Fund A","QRXFGEN",4,"QRX F GEN",81900520,5410\n'
                   '10,10,"Fund B","TUVAFND",,"TUV A F ND",,5430\n'
                   '68,68,"Fund C","qrxfgen",4,"QRX F GEN",81900520,5410\n')
FUNDS_PLAIN_CRLF = ('rowid,FiscalFundId,FundName,IlsFundCode,IlsFundCodeNumeric,IlsFundCodeSpaces,GLKey,GLObj\r\n'
                    '1,1,Fund A,QRXFGEN,4,QRX F GEN,81900521,5410\r\n'
                    '2,2,Fund B,TUVAFND,5,TUV A F ND,20102202,5430\r\n')
FUNDS_NO_ROWID = ('FiscalFundId,FundName,IlsFundCode,IlsFundCodeNumeric,IlsFundCodeSpaces,GLKey,GLObj\n'
                  '1,Fund A,QRXFGEN,4,QRX F GEN,8119100115,5410\n')


def _write(tmp, name, text):
    p = os.path.join(tmp, name)
    with open(p, "w", newline="") as f:
        f.write(text)
    return p


def test_fund_csv_layouts(spark, tmp):
    a = read_fiscal_funds(spark, _write(tmp, "a.csv", FUNDS_QUOTED_LF)).orderBy("FiscalFundId").collect()
    assert [r.FiscalFundId for r in a] == [1, 10, 68]
    assert a[1].GLKey is None and a[1].IlsFundCodeNumeric is None and a[1].GLObj == 5430
    b = read_fiscal_funds(spark, _write(tmp, "b.csv", FUNDS_PLAIN_CRLF)).orderBy("FiscalFundId").collect()
    assert [(r.IlsFundCode, r.GLObj) for r in b] == [("QRXFGEN", 5410), ("TUVAFND", 5430)]
    c = read_fiscal_funds(spark, _write(tmp, "c.csv", FUNDS_NO_ROWID))
    assert dict(c.dtypes)["GLKey"] == "bigint" and c.first().GLKey == 8119100115
    assert "rowid" not in c.columns


def test_fund_csv_with_other_titles(spark, tmp):
    text = ("Id,FiscalFundId,FundName,LegacyFundCode,LegacyFundCodeNumeric,LegacyFundCodeSpaces,Account,GLObj\n"
            "5,5,Fund,XYZ,7,X Y Z,8100000500,5450\n")
    r = read_fiscal_funds(spark, _write(tmp, "d.csv", text), titles={"Account": "GLKey"}).first()
    assert tuple(r) == (5, "Fund", "XYZ", 7, "X Y Z", 8100000500, 5450)
    with pytest.raises(ValueError, match="GLKey"):
        read_fiscal_funds(spark, _write(tmp, "e.csv", text))


def test_malformed_numbers_raise_and_are_counted(spark, tmp):
    path = _write(tmp, "f.csv", FUNDS_NO_ROWID + "x,Fund A,QRXFGEN,4,QRX F GEN,81-1,\n")
    assert rejected_values(spark, path, FISCAL_FUND_COLUMNS).first().asDict() == {
        "FiscalFundId": 1, "IlsFundCodeNumeric": 0, "GLKey": 1, "GLObj": 0, "broken_lines": 0}
    with pytest.raises(Exception, match="is no"):
        read_fiscal_funds(spark, path).collect()


def test_refresh_reads_a_file_with_prefixed_titles(spark, tmp, small_dir, source_root):
    """The fund file's own header gives ledger keys, through a full refresh;
    its broken lines are published beside the list."""
    src = TestSources(spark, small_dir)
    export_csv(src.fiscal_funds.coalesce(1), f"{tmp}/funds.csv", {c: c.replace("Ils", "Legacy") for c in src.fiscal_funds.columns})
    file = next(f for f in os.listdir(f"{tmp}/funds.csv") if f.endswith(".csv"))
    with open(f"{tmp}/funds.csv/{file}") as f:
        funds = _write(tmp, "office.csv", f.read() + "900,short\n901,long,X,1,X,5,6,7,8\n")
    base = main(["--sources", source_root, "--fiscal-funds", funds, "--out", f"{tmp}/out",
                 "--ledger-files", f"{tmp}/files"])
    ledger = spark.read.parquet(f"{base}/ledger_lines_alt_view")
    assert ledger.filter("gl_key is not null").count() > 0
    assert "posted_month" in ledger.columns and ledger.filter(
        "posted_month <> date_format(posted_date, 'yyyy-MM')").count() == 0
    for name, headers, view in (("ledger", LEDGER_HEADERS, "ledger_export_view"),
                                ("ledger_alt", ALT_LEDGER_HEADERS, "ledger_lines_alt_view")):
        back = spark.read.option("header", True).csv(f"{tmp}/files/{name}")
        assert back.columns[:len(headers)] == list(headers.values())
        assert back.count() == spark.read.parquet(f"{base}/{view}").count()
    assert sorted(r.line for r in read_current(spark, f"{tmp}/out", "fiscal_funds_broken").collect()) == [
        "900,short", "901,long,X,1,X,5,6,7,8"]
    names = open_snapshot(spark, f"{tmp}/out")
    assert {"fiscal_funds", "fiscal_vendors", "orders", "ledger_export_view"} <= set(names)
    assert spark.table("fiscal_funds").count() == src.fiscal_funds.count()
    year = Q.browse(spark.table("ledger_lines_alt_view"), gte={"posted_date": "1997-01-01"}, lte={"posted_date": "1997-12-31"})
    plan = year._jdf.queryExecution().executedPlan().toString()
    assert "posted_month" in plan.split("PartitionFilters")[1][:200]
    assert year.count() == spark.table("ledger_lines_alt_view").filter("year(posted_date) = 1997").count()


def test_exported_report_is_sorted(spark, tmp, small_dir):
    from procura.plans.registry import reports_for
    shown = Q.in_order(reports_for(spark, small_dir).vendors_summary_view, "vendors_summary_view").collect()
    dates = [str(r.last_order_date or "") for r in shown]
    assert dates == sorted(dates, reverse=True)


def test_vendor_csv(spark, tmp):
    p = _write(tmp, "v.csv", "FiscalVendorId,FiscalVendorCode,VendorName,IlsVendorCode\n7,FV7,\"A, B\",v7\n")
    r = read_fiscal_vendors(spark, p).first()
    assert (r.FiscalVendorId, r.FiscalVendorCode, r.VendorName, r.IlsVendorCode) == (7, "FV7", "A, B", "v7")


class _FakeJdbc:
    """Records how relations are read; the key splits are given."""

    def __init__(self, splits):
        self.splits, self.calls = splits, []
        self.read = self

    def jdbc(self, url, table, **kw):
        self.calls.append((table, kw))
        return self

    def collect(self):
        return self.splits


def test_jdbc_reads_large_relations_in_parts():
    fake = _FakeJdbc([(5, 70), (9, 3)])
    src = SourceCatalog.jdbc(fake, "jdbc:x", {"user": "u"}, "s", "v.csv", "f.csv")
    assert src.fund_master is fake and fake.calls == [("s.fund_master", {"properties": {"fetchsize": "10000", "user": "u"}})]
    assert src.invoice_record_line is fake
    (asked, _), (table, kw) = fake.calls[-2:]
    assert "row_number() over (order by invoice_record_id, id)" in asked and table == "s.invoice_record_line"
    assert len(kw["predicates"]) == 3 and kw["properties"]["fetchsize"] == "10000"
    empty = _FakeJdbc([])
    assert SourceCatalog.jdbc(empty, "jdbc:x", {}, "s", "v", "f").varfield is empty and "predicates" not in empty.calls[-1][1]


@pytest.mark.parametrize("key", [("k", "id"), ("id",), ("k", "name")])
def test_jdbc_parts_are_balanced_on_a_skewed_key(key):
    """The SQL that the source is asked, run on a table where one key has
    two thirds of the rows, keys have gaps, and some rows have no key."""
    import duckdb

    from procura.sources.catalog import split_predicates, split_query
    con = duckdb.connect()
    con.execute("create table t as select range as id, 'n''' || range as name, "
                "case when range < 2000 then 77 when range < 2900 then range * range else null end as k from range(3000)")
    size = 100
    splits = con.execute(f"select * from {split_query('t', key, size)}").fetchall()
    parts = split_predicates(key, splits)
    counts = [con.execute(f"select count(*) from t where {p}").fetchone()[0] for p in parts]
    nulls = con.execute(f"select count(*) from t where {key[0]} is null").fetchone()[0]
    assert sum(counts) == 3000 and len(parts) == (3000 - nulls) // size
    assert counts[0] == size + nulls and set(counts[1:]) <= {size}
    assert con.execute("select count(*) from t where " + " or ".join(f"({p})" for p in parts)).fetchone()[0] == 3000
    assert split_predicates(key, []) == ["1 = 1"]


BROKEN_FUNDS = (FUNDS_NO_ROWID + '2,Fund B,TUVAFND,5\n3,Fund C,ABC,6,A B C,77,5430,too,many\n'
                '"4","Fund, D","DEF",7,"D E F",78,5430\n\n5\n')


def test_broken_lines_are_reported_and_not_loaded(spark, tmp):
    from procura.sources.files import broken_rows
    path = _write(tmp, "broken.csv", BROKEN_FUNDS)
    got = read_fiscal_funds(spark, path).orderBy("FiscalFundId").collect()
    assert [(r.FiscalFundId, r.FundName, r.GLKey) for r in got] == [(1, "Fund A", 8119100115), (4, "Fund, D", 78)]
    # whichever columns are asked for
    assert read_fiscal_funds(spark, path).select("FiscalFundId").count() == 2
    assert read_fiscal_funds(spark, path).filter("IlsFundCode = 'TUVAFND'").count() == 0
    bad = broken_rows(spark, path, FISCAL_FUND_COLUMNS).collect()
    assert sorted(tuple(r) for r in bad) == [("broken.csv", "2,Fund B,TUVAFND,5"),
                                             ("broken.csv", "3,Fund C,ABC,6,A B C,77,5430,too,many"), ("broken.csv", "5")]
    assert rejected_values(spark, path, FISCAL_FUND_COLUMNS).first()["broken_lines"] == 3
    assert broken_rows(spark, _write(tmp, "good.csv", FUNDS_NO_ROWID), FISCAL_FUND_COLUMNS).count() == 0


def test_every_mart_and_report_can_be_shown(spark, small_dir):
    from procura.plans.registry import reports_for
    from procura.plans.reports import VIEW_ORDER
    r = reports_for(spark, small_dir)
    names = Q.register_views(spark, r.m, r)
    assert set(names) == set(MART_NAMES + REPORT_NAMES) - {"invoice_header", "invoice_lines_flat"}
    for name in {*names, *MART_NAMES}:
        df = getattr(r, name) if name in REPORT_NAMES else getattr(r.m, name)
        assert Q.in_order(df, name).columns == df.columns, name
    for name in ("varfield_metadata", "invoice_record_order_record_link", "vendors", "invoice_record_vendor_summary",
                 "vendors_summary_last_invoice_view", "fund"):
        assert name in VIEW_ORDER
    link = Q.in_order(r.m.invoice_record_order_record_link, "invoice_record_order_record_link").limit(500).collect()
    assert link == sorted(link, key=lambda x: (x.invoice_record_id, x.order_record_id)) and link
    num = [x.invoice_record_vendor_summary_id for x in
           Q.in_order(r.m.invoice_record_vendor_summary, "invoice_record_vendor_summary").collect()]
    assert num == sorted(num, reverse=True)
    with pytest.raises(ValueError, match="no mart or report is called 'ledger'"):
        Q.in_order(r.peid_view, "ledger")


def test_write_table_conform_and_csv_export(spark, tmp):
    df = spark.createDataFrame([(1, "x", [(1, None)])], "a bigint, b string, c array<struct<p:int,q:string>>")
    schema = spark.createDataFrame([], "b string, a int").schema
    write_table(conform(df, schema), f"{tmp}/t", sort_within=["a"])
    back = spark.read.parquet(f"{tmp}/t")
    assert back.schema == schema and back.count() == 1
    export_csv(df, f"{tmp}/csv", headers={"a": "Col A"})
    txt = spark.read.option("header", True).csv(f"{tmp}/csv").first()
    assert txt["Col A"] == "1" and txt["c"] == '[{"p":1,"q":null}]'


def test_save_report_as_catalog_table(spark, small_dir):
    from procura.plans.registry import reports_for
    from procura.sources.sinks import save_report
    r = reports_for(spark, small_dir)
    save_report(r.fund_use, "fund_use_test")
    assert spark.table("fund_use_test").count() == r.fund_use.count()
    spark.sql("drop table fund_use_test")


def test_snapshot_publish_switches_pointer(spark, tmp):
    one = spark.range(3).withColumn("v", F.lit("a"))
    two = spark.range(5).withColumn("v", F.lit("b"))
    p1 = publish_snapshot(spark, {"t": one}, tmp, label="1")
    assert current_snapshot(spark, tmp) == p1 and read_current(spark, tmp, "t").count() == 3
    p2 = publish_snapshot(spark, {"t": two}, tmp, label="2")
    assert current_snapshot(spark, tmp) == p2 and read_current(spark, tmp, "t").count() == 5
    assert spark.read.parquet(f"{p1}/t").count() == 3  # the old snapshot is untouched


def test_full_refresh(spark, tmp, source_root):
    src = SourceCatalog.parquet(spark, source_root)
    base = refresh(spark, src, tmp, label="t")
    assert current_snapshot(spark, tmp) == base
    for n in MART_NAMES + REPORT_NAMES + FISCAL_NAMES + LEDGER_TABLES:
        assert os.path.isdir(f"{base}/{n}"), n
    # reports built from the stored marts equal the ones built in one plan
    stored = spark.read.parquet(f"{base}/ledger_export_view").drop("posted_month")
    direct = QUERIES["ledger_export_distinct"].on_marts(Marts(src))
    assert stored.count() == direct.count()
    assert stored.select(sorted(stored.columns)).exceptAll(direct.select(sorted(direct.columns))).count() == 0
    alloc = spark.read.parquet(f"{base}/invoice_line_data")
    assert alloc.count() == QUERIES["invoice_line_allocation"].on_marts(Marts(src)).count()


def test_writes_leave_no_shuffle_files(spark, tmp):
    from procura.session import SHUFFLE_CLEANUP, shuffles_released

    def shuffle_files():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {blocks.apply(i).getName() for i in range(blocks.size()) if blocks.apply(i).getName().startswith("shuffle_")}

    df = spark.range(0, 1000, 1, 4).groupBy((F.col("id") % 50).alias("k")).agg(F.max("id").alias("v"))
    before = shuffle_files()
    write_table(df, f"{tmp}/plain", sort_within=["k"])
    write_table(df, f"{tmp}/dealt", buckets={"by": ["k"], "count": 3})
    export_csv(df.orderBy("k"), f"{tmp}/csv")
    assert not shuffle_files() - before
    assert spark.conf.get(SHUFFLE_CLEANUP, "false") == "false"
    with shuffles_released(spark), shuffles_released(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
