"""Declared mart schemas, canned SQL with named parameters, and filter
pushdown when a stored report is browsed."""

from pyspark.sql import functions as F

from procura.plans import queries as Q
from procura.plans.registry import marts_for, reports_for
from procura.schemas import MART_DDL, mart_schema


def _shape(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def test_marts_match_declared_schemas(spark, small_dir):
    m = marts_for(spark, small_dir)
    for name in MART_DDL:
        assert _shape(getattr(m, name).schema) == _shape(mart_schema(name)), name


def test_canned_queries_and_views(spark, small_dir):
    r = reports_for(spark, small_dir)
    Q.register_views(spark, r.m, r)
    link = r.m.invoice_record_order_record_link.first()
    got = Q.run_canned(r.m, "invoice_with_order", order_record_num=link.order_record_num)
    assert link.invoice_record_num in {x.invoice_record_num for x in got.collect()}
    fund = spark.sql("select o.order_record_num from orders o lateral view explode(o.cmf_data) as kid "
                     "where kid.fund_code = :f and o.order_status_code = 'o'", args={"f": "brd13"})
    assert fund.count() == Q.run_canned(r.m, "on_order_fund_code", fund_code="brd13").count()


def test_lookups_are_sorted(spark, small_dir):
    m = marts_for(spark, small_dir)
    three = [(str(r.creation_date), r.order_record_num) for r in Q.multi_fund_orders(m, 2, "o").collect()]
    assert three == sorted(three) and len(three) > 1
    counts = [r["count"] for r in Q.order_status_counts(m).collect()]
    assert counts == sorted(counts, reverse=True)
    numbers = [r.order_record_num for r in Q.on_order_list(m).collect()]
    assert numbers == sorted(numbers)


def test_lookups_filter_below_the_nesting(spark, small_dir):
    """The semi-join that picks the parents lies under the aggregate that
    nests their children."""
    m = marts_for(spark, small_dir)
    for df in (Q.invoices_for_order(m, 1_000_100), Q.on_order_by_fund(m, "brd13"), Q.multi_fund_orders(m, 2, "o")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftSemi" in plan.split("collect_list", 1)[1]


def test_browse_pushes_range_filter_to_parquet(spark, small_dir, tmp):
    r = reports_for(spark, small_dir)
    r.ledger_lines_alt_view.write.parquet(f"{tmp}/alt")
    stored = spark.read.parquet(f"{tmp}/alt")
    b = Q.browse(stored, gte={"posted_date": "1997-01-01"}, lte={"posted_date": "1997-12-31"},
                 hide=["extra_data"])
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "posted_date" in plan.split("PushedFilters")[1][:300]
    assert "extra_data" not in b.columns
    assert b.filter(F.year("posted_date") != 1997).count() == 0
