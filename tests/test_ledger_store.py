"""Bucketed tables and the ledgers over them; published look-ups; months
that are carried over to the next snapshot."""

import os

import pytest
from pyspark.sql import functions as F

from procura.plans import queries as Q
from procura.plans.ledger_store import KEYS, LEDGER_TABLES, BucketedReports, write_ledger_tables
from procura.plans.marts import Marts
from procura.plans.refresh import MONTHLY, ledger_state, refresh, write_months
from procura.plans.reports import Reports
from procura.sources.buckets import bucket_count, open_bucketed
from procura.sources.catalog import SourceCatalog
from procura.sources.sinks import current_commit, read_current, write_table
from tools.plans import summarise


def same_rows(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    return a.select(cols).exceptAll(b.select(cols)).count() == 0 and b.select(cols).exceptAll(a.select(cols)).count() == 0


def test_bucket_count():
    assert bucket_count(0) == 8 and bucket_count(20_000_001) == 11 and bucket_count(10 ** 15) == 50_000


def test_bucketed_tables_join_and_group_without_a_shuffle(spark, tmp):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(5000).select((F.col("id") % 700).alias("k"), F.col("id").alias("v"))
        one = write_table(df, f"{tmp}/one", buckets={"by": ["k"], "count": 4, "sort_by": ["v"]})
        two = write_table(df.groupBy("k").count(), f"{tmp}/two", buckets={"by": ["k"], "count": 4})
        assert one.figures["rows"] == 5000 and one.buckets == {"by": ["k"], "count": 4, "sort_by": ["k", "v"]}
        files = [f for f in os.listdir(f"{tmp}/one") if f.endswith(".parquet")]
        assert len(files) == 4  # one a bucket
        joined = one.read(spark).join(two.read(spark), "k").groupBy("k").agg(F.sum("v").alias("s"), F.max("count"))
        joined.write.format("noop").mode("overwrite").save()
        assert summarise(joined._jdf.queryExecution().executedPlan())["shuffles"] == 0
        assert joined.agg(F.sum("s")).first()[0] == sum(range(5000))
        # the declaration is all that another session needs
        again = open_bucketed(spark, one.path, df.schema, **one.buckets)
        assert again.count() == 5000 and spark.read.parquet(one.path).count() == 5000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def stored(spark, source_root, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("ledger"))
    m = Marts(SourceCatalog.parquet(spark, source_root), chunk_size=64)  # small, so that invoices have several chunks
    tables = write_ledger_tables(Reports(m), f"{root}/t", 8)
    return m, {n: t.read(spark) for n, t in tables.items()}


def test_ledgers_over_bucketed_tables(stored):
    m, tables = stored
    plain, over = Reports(m), BucketedReports(m, tables)
    for name in ("ledger_export_table", "ledger_export_view", "ledger_lines_alt_view"):
        assert same_rows(getattr(plain, name), getattr(over, name)), name
        assert getattr(plain, name).columns == getattr(over, name).columns


@pytest.mark.parametrize("threshold", ["10m", "20k"])
def test_lines_meet_their_invoice_without_a_shuffle(spark, stored, threshold):
    m, tables = stored
    # with the small one, look-ups alone are broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for name, scans in (("ledger_export_table", 4), ("ledger_export_view", 4), ("ledger_lines_alt_view", 5)):
            df = getattr(BucketedReports(m, tables), name)
            df.write.format("noop").mode("overwrite").save()
            s = summarise(df._jdf.queryExecution().executedPlan())
            assert (s["shuffles"], s["scans"]) == (0, scans), (name, s)
            assert (s["smj"] > 0) == (threshold == "20k"), (name, s)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_bucket_holds_a_whole_huge_invoice(stored):
    _, tables = stored
    lines = tables["ledger_lines"]
    top = lines.groupBy("invoice_record_id").count().orderBy(F.desc("count")).first()
    mine = lines.filter(F.col("invoice_record_id") == top["invoice_record_id"])
    positions = mine.groupBy(*KEYS).agg(F.countDistinct("seq").alias("n")).agg(F.max("n"), F.count("*")).first()
    assert positions[0] <= 64 < top["count"] and positions[1] > 2
    heads = tables["ledger_invoices"].groupBy("invoice_record_id").agg(F.count_if("is_first_chunk").alias("n"))
    assert heads.filter("n <> 1").count() == 0


@pytest.fixture(scope="module")
def snapshots(spark, source_root, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("snapshots"))
    catalog = SourceCatalog.parquet(spark, source_root)
    refresh(spark, catalog, f"{root}/out", label="1")
    return root, catalog


def test_published_look_ups(spark, snapshots):
    root, catalog = snapshots
    m = Marts(catalog)
    p = Q.PublishedQueries(lambda n: read_current(spark, f"{root}/out", n))
    orders = [r[0] for r in read_current(spark, f"{root}/out", "invoice_record_order_record_link")
              .select("order_record_num").distinct().orderBy("order_record_num").limit(2).collect()]
    for num in [*orders, -1]:
        got = p.invoices_for_order(num)
        assert same_rows(got, Q.invoices_for_order(m, num))
        got.write.format("noop").mode("overwrite").save()
        assert summarise(got._jdf.queryExecution().executedPlan())["scans"] < 8
    fund = read_current(spark, f"{root}/out", "order_funds_flat").filter("fund_code is not null").first().fund_code
    assert same_rows(p.on_order_by_fund(fund), Q.on_order_by_fund(m, fund)) and p.on_order_by_fund("none").count() == 0
    assert same_rows(p.multi_fund_orders(1, "o"), Q.multi_fund_orders(m, 1, "o"))


def test_bloom_filters_are_written(spark, tmp):
    """For columns with more values than a dictionary holds (one that fits
    tells as much)."""
    df = spark.range(400_000).select(F.md5(F.col("id").cast("string")).alias("code"), "id").repartition(1)
    with_filter = write_table(df, f"{tmp}/with", find_by={"code": 400_000})
    without = write_table(df, f"{tmp}/without")
    assert with_filter.figures == without.figures

    def size(path):
        return sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".parquet"))

    assert size(with_filter.path) - size(without.path) > 400_000  # a byte and more for each value
    code = df.first().code
    assert with_filter.read(spark).filter(F.col("code") == code).count() == 1


@pytest.mark.parametrize("n", [1, 10, 400, 10 ** 7])
def test_first_page_reads_the_first_files(spark, snapshots, n):
    root, _ = snapshots
    p = Q.PublishedQueries(lambda name: read_current(spark, f"{root}/out", name))
    every = read_current(spark, f"{root}/out", "ledger_lines_alt_view").drop("posted_month")
    got = p.first_ledger_rows(n)
    assert got.collect() == Q.in_order(every, "ledger_lines_alt_view").limit(n).collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("LessThanOrEqual(pe_id" in plan or "IsNull(pe_id)" in plan) == (every.count() >= n)


def test_published_range_reads_its_months(spark, snapshots):
    root, catalog = snapshots
    p = Q.PublishedQueries(lambda n: read_current(spark, f"{root}/out", n))
    got = p.ledger_lines_between("1997-02-10", "1997-05-05", hide=["extra_data"])
    assert same_rows(got, Q.ledger_lines_between(Marts(catalog), "1997-02-10", "1997-05-05", hide=["extra_data"]))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "posted_month" in plan.split("PartitionFilters")[1][:200] and got.count() > 0


def test_payees_are_counted_before_the_look_ups(spark, stored):
    m, tables = stored
    for r in (Reports(m), BucketedReports(m, tables)):
        assert same_rows(r.ledger_lines_alt_counts, Q.facet_counts(r.ledger_lines_alt_view, "pe_id").withColumnRenamed("value", "pe_id"))


def test_published_facet(spark, snapshots):
    root, catalog = snapshots
    p = Q.PublishedQueries(lambda n: read_current(spark, f"{root}/out", n))
    assert same_rows(p.ledger_facet(), Q.facet_counts(Reports(Marts(catalog)).ledger_lines_alt_view, "pe_id"))


def test_equal_months_are_not_written_again(spark, snapshots, tmp):
    """What the refresh does for the ledgers, over the same stored tables."""
    root, _ = snapshots
    commit = current_commit(spark, f"{root}/out")
    r = BucketedReports(Marts(snapshots[1]), {n: commit.tables[n].read(spark) for n in LEDGER_TABLES})
    state = {row.posted_month: row.state for row in ledger_state(r, commit.tables).collect()}
    for name in MONTHLY:
        again = write_months(spark, getattr(r, name), name, tmp, state, commit.tables[name])
        assert not os.path.exists(f"{tmp}/{name}") and list(again.months) == [f"{root}/out/snapshot=1/{name}"]
        assert same_rows(again.read(spark), commit.tables[name].read(spark))
        assert spark.sql(again.sql()).count() == again.read(spark).count()


def test_a_changed_month_alone_is_written(spark, snapshots):
    """Last in this file: it publishes another snapshot."""
    root, catalog = snapshots
    when = catalog.invoice_record.filter("posted_data_gmt is not null").agg(F.max("posted_data_gmt")).first()[0]
    month = when.strftime("%Y-%m")

    class Changed:
        def __getattr__(self, name):
            df = getattr(catalog, name)
            if name == "invoice_record":
                mine = F.date_format("posted_data_gmt", "yyyy-MM") == month
                return df.withColumn("invoice_number_text", F.when(mine, F.lit("NEW")).otherwise(F.col("invoice_number_text")))
            return df

    refresh(spark, Changed(), f"{root}/out", label="2")
    table = current_commit(spark, f"{root}/out").tables["ledger_lines_alt_view"]
    assert list(table.months[table.path]) == [month] and len(table.months) == 2
    got = read_current(spark, f"{root}/out", "ledger_lines_alt_view").drop("posted_month")
    assert same_rows(got, Reports(Marts(Changed())).ledger_lines_alt_view)
    assert spark.sql(table.sql()).count() == got.count()
    late = Q.browse(read_current(spark, f"{root}/out", "ledger_lines_alt_view"), gte={"posted_date": f"{month}-01"})
    assert late.filter("ref <> 'NEW'").count() == 0 and late.count() > 0
