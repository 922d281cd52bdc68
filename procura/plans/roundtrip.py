"""Registered round trips through the sources and sinks.

Each writes a derived relation through the real sink into a folder of its own
under the checkpoint folder, reads it back through the real source and returns
what was read.  Unlike all other registered queries they therefore run jobs
while they are built: the write is the point.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procura.plans.ledger_store import LEDGER_TABLES, BucketedReports, write_ledger_tables
from procura.plans.marts import Marts
from procura.plans.queries import PublishedQueries, _json_arrays, in_order
from procura.plans.refresh import LAYOUT
from procura.plans.reports import ALT_LEDGER_HEADERS, VIEW_ORDER, Reports
from procura.schemas import mart_schema
from procura.session import owned_folder
from procura.sources.buckets import bucket_count
from procura.sources.catalog import SourceCatalog, export_sources
from procura.sources.files import read_fiscal_funds, read_fiscal_vendors
from procura.sources.sinks import export_csv, open_snapshot, publish_snapshot, read_current, save_report, write_table

FUND_RELATIONS = ("fund_master", "accounting_unit", "fund_myuser", "external_fund_property",
                  "external_fund_property_name")


def fiscal_funds_file(m: Marts) -> DataFrame:
    """The fund list as a CSV whose titles carry a system's name."""
    path = owned_folder(m.src.spark, "funds-csv")
    export_csv(m.src.fiscal_funds, path, {c: c.replace("Ils", "Legacy") for c in m.src.fiscal_funds.columns})
    return read_fiscal_funds(m.src.spark, path)


def fiscal_vendors_file(m: Marts) -> DataFrame:
    """The vendor list as a CSV with one title named by the caller."""
    path = owned_folder(m.src.spark, "vendors-csv")
    export_csv(m.src.fiscal_vendors, path, {"IlsVendorCode": "Code"})
    return read_fiscal_vendors(m.src.spark, path, titles={"Code": "IlsVendorCode"})


def stored_sources_fund(m: Marts) -> DataFrame:
    """S3: the fund mart over stored source relations."""
    path = owned_folder(m.src.spark, "sources")
    export_sources(m.src, path, FUND_RELATIONS)
    return Marts(SourceCatalog.parquet(m.src.spark, path)).fund


def typed_vendors_table(m: Marts) -> DataFrame:
    """The vendor mart as a table of its declared types."""
    path = owned_folder(m.src.spark, "vendors")
    write_table(m.vendors, path, schema=mart_schema("vendors"), sort_within=["vendor_record_id"])
    return _json_arrays(m.src.spark.read.schema(mart_schema("vendors")).parquet(path))


def stored_fund_use(r: Reports) -> DataFrame:
    """A materialised report."""
    path = owned_folder(r.src.spark, "fund-use")
    save_report(r.fund_use, "fund_use", path)
    return r.src.spark.read.parquet(path)


def ledger_alt_file(r: Reports) -> DataFrame:
    """The second ledger format as a sorted CSV with export titles."""
    path = owned_folder(r.src.spark, "ledger-csv")
    df = r.ledger_lines_alt_view
    export_csv(in_order(df, "ledger_lines_alt_view"), path, ALT_LEDGER_HEADERS)
    back = r.src.spark.read.option("header", True).csv(path)
    return back.select(*[F.col(f"`{ALT_LEDGER_HEADERS.get(f.name, f.name)}`").cast(f.dataType).alias(f.name)
                         for f in df.schema.fields])


def published_receipts(m: Marts) -> DataFrame:
    """A table of the published snapshot."""
    root = owned_folder(m.src.spark, "snapshots")
    publish_snapshot(m.src.spark, {"order_record_received": m.order_record_received}, root)
    return read_current(m.src.spark, root, "order_record_received")


def fund_use_view(r: Reports) -> DataFrame:
    """A report through a catalog view over the published snapshot."""
    spark = r.src.spark
    root, database = owned_folder(spark, "snapshots"), f"procura_{uuid.uuid4().hex}"
    publish_snapshot(spark, {"fund_use": r.fund_use}, root)
    open_snapshot(spark, root, database)
    return spark.sql(f"SELECT * FROM `{database}`.fund_use")


def bucketed(report: Callable[[Reports], DataFrame]) -> Callable[[Reports], DataFrame]:
    """A ledger report over the bucketed ledger tables."""
    def run(r: Reports) -> DataFrame:
        return report(bucketed_reports(r))
    return run


def bucketed_reports(r: Reports) -> BucketedReports:
    spark = r.src.spark
    buckets = bucket_count(r.src.invoice_record_line.count())
    tables = write_ledger_tables(r, owned_folder(spark, "ledger"), buckets)
    return BucketedReports(r.m, {n: tables[n].read(spark) for n in LEDGER_TABLES})


def published(*names: str) -> Callable[[Callable[[PublishedQueries], DataFrame]], Callable[[Marts], DataFrame]]:
    """A query over the named marts, written in the layout of the refresh."""
    def query(ask: Callable[[PublishedQueries], DataFrame]) -> Callable[[Marts], DataFrame]:
        def run(m: Marts) -> DataFrame:
            base = owned_folder(m.src.spark, "published")
            tables = {n: write_table(getattr(m, n), f"{base}/{n}", **LAYOUT.get(n, {})) for n in names}
            return ask(PublishedQueries(lambda n: tables[n].read(m.src.spark)))
        return run
    return query


def published_ledger(ask: Callable[[PublishedQueries], DataFrame]) -> Callable[[Reports], DataFrame]:
    """A query over the second ledger format as the refresh publishes it."""
    def run(r: Reports) -> DataFrame:
        spark, base, name = r.src.spark, owned_folder(r.src.spark, "published"), "ledger_lines_alt_view"
        ledger = write_table(bucketed_reports(r).ledger_lines_alt_view, f"{base}/{name}", **LAYOUT[name])
        lead = VIEW_ORDER[name][0][0]
        counts = write_table(ledger.read(spark).groupBy(lead).count(), f"{base}/counts")
        return ask(PublishedQueries(lambda n: (ledger if n == name else counts).read(spark)))
    return run
