"""Look-ups cut lines and children down before these are numbered, and give
the same rows as the marts over everything."""

import re

import pytest
from pyspark.sql import functions as F

from procura.plans import queries as Q
from procura.plans.ledger_store import LINE_COLUMNS, ledger_lines
from procura.plans.registry import marts_for
from procura.plans.reports import Reports
from procura.sources.subset import MARKS, _keep, only_invoices
from tests.fakes import FakeSources


def _below(df, mark):
    """The optimized plan under the first numbering of parents by ``mark``."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda s: len(s) - len(s.lstrip(" :+-"))
    at = next(i for i, s in enumerate(lines) if "row_number()" in s and mark in s)
    under = []
    for s in lines[at + 1:]:
        if depth(s) <= depth(lines[at]):
            break
        under.append(s)
    return "\n".join(under)


@pytest.fixture
def marts(spark, small_dir):
    return marts_for(spark, small_dir)


def test_lines_of_a_lookup_are_dropped_before_they_are_numbered(spark, marts):
    ids = spark.range(1).select((F.col("id") + (1 << 56) + 1093).alias("invoice_record_id"))
    kept = only_invoices(marts.src, ids, few=True).invoice_record_line.select("id")
    under = _below(kept, "invoice_record_id")
    assert "array_contains(scalar-subquery" in under and "LeftSemi" in under


def test_children_are_dropped_before_they_are_numbered(marts):
    # of the fund's orders on order alone
    plan = Q.on_order_by_fund(marts, "brd13")
    under = _below(plan, "order_record_id")
    assert under.count("LeftSemi") >= 2


@pytest.mark.parametrize("few", [False, True])
def test_kept_rows(spark, few):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e")], "k long, v string")
    ids = spark.createDataFrame([(1,), (1,), (None,), (9,)], "k long")
    assert sorted(r.v for r in _keep(rows, "k", ids, few).collect()) == ["a", "b"]
    assert _keep(rows, "k", ids.limit(0), few).count() == 0
    many = spark.range(4 * MARKS).select(F.col("id").alias("k"))
    assert _keep(many, "k", many.filter("k % 3 = 0"), few).count() == many.filter("k % 3 = 0").count()


def test_lookups_over_repeated_and_missing_keys(spark, small_dir):
    """A record number and a line twice, an order without a number: as the marts
    over everything give them."""
    meta = [dict(id=11, record_num=5, record_type_code="o"), dict(id=11, record_num=5, record_type_code="o"),
            dict(id=12, record_num=6, record_type_code="o"), dict(id=21, record_num=7, record_type_code="n"),
            dict(id=22, record_num=8, record_type_code="n")]
    lines = [dict(id=1, invoice_record_id=21, line_cnt=0, order_record_metadata_id=11),
             dict(id=1, invoice_record_id=21, line_cnt=0, order_record_metadata_id=11),
             dict(id=2, invoice_record_id=21, line_cnt=1, order_record_metadata_id=None),
             dict(id=3, invoice_record_id=22, line_cnt=0, order_record_metadata_id=12),
             dict(id=4, invoice_record_id=None, line_cnt=0, order_record_metadata_id=11)]
    src = FakeSources(spark, small_dir, record_metadata=meta, invoice_record_line=lines,
                      invoice_record=[dict(id=i, record_id=i) for i in (21, 22)])
    m = Q.Marts(src, materialize="none")
    got = Q.invoices_for_order(m, 5).collect()
    want = Q._json_arrays(m.invoice.filter("invoice_record_num = 7")).collect()
    assert [str(r) for r in got] == [str(r) for r in want] and len(got) == 1


def test_an_ordinary_invoice_is_allocated_on_one_clustering(marts):
    # the merge of equal lines and the sums need no shuffle of their own
    plan = marts.invoice_line_data._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\(invoice_record_id#\d+L?, invoice_record_num#\d+L?, paid_amt#\d+, subtotal_amt#\d+, "
                         r"grand_total_amt#\d+, line_cnt#\d+, \d+\)", plan)


def test_stored_ledger_lines_hold_what_the_ledgers_read(marts):
    assert ledger_lines(Reports(marts)).columns == [*LINE_COLUMNS, "line_chunk"]
    assert not {"_line_id", "_ild_inv", "_ild_line", "_ild_total", "fund_code"} & set(LINE_COLUMNS)


def test_published_invoices_of_an_order_are_cut_down_where_they_are_read(spark):
    tables = {"invoice_record_order_record_link": spark.createDataFrame(
                  [(1, 7), (1, 7), (None, 7), (2, 8)], "invoice_record_id long, order_record_num long"),
              "invoice": spark.createDataFrame([(1, 11, None), (2, 12, None), (None, 13, None)],
                                               "invoice_record_id long, invoice_record_num long, last_updated date")}
    found = Q.PublishedQueries(tables.get).invoices_for_order(7)
    assert "array_contains(scalar-subquery" in found._jdf.queryExecution().optimizedPlan().toString()
    assert [r.invoice_record_num for r in found.collect()] == [11]
