"""Invariants on the marts over the small test tables."""

from pyspark.sql import functions as F

from procura.plans.registry import marts_for


def test_allocation_reaches_grand_total(spark, small_dir):
    """Per posted invoice with a non-zero subtotal: last running total +
    residual = grand total, and the residual is what is_off flags."""
    a = marts_for(spark, small_dir).invoice_line_data
    # invoices of 89 lines and more have lines without a position, which come after the last one
    last = a.filter(F.col("line_cnt") == F.col("total_lines")).filter("subtotal_amt_cents <> 0 and total_lines < 89")
    assert last.count() > 0
    bad = last.filter(F.col("running_adjusted_total_paid_cents") + F.col("off_amt_cents")
                      != F.col("grand_total_amt_cents"))
    assert bad.count() == 0
    assert last.filter(F.col("is_off") != (F.col("off_amt_cents") != 0)).count() == 0
    # the residual of a proportional split stays within a cent per line
    assert last.filter(F.abs("off_amt_cents") > F.col("total_lines")).count() == 0


def test_links_are_distinct(spark, small_dir):
    link = marts_for(spark, small_dir).invoice_record_order_record_link
    assert link.count() == link.distinct().count()


def test_fund_children_count_matches_array(spark, small_dir):
    o = marts_for(spark, small_dir).orders
    assert o.filter(F.size("cmf_data") != F.col("count_cmf")).count() == 0
    assert o.filter(F.col("count_cmf") == 0).count() == 0  # orders without children drop out


def test_invoice_without_lines_has_one_null_line(spark, small_dir):
    inv = marts_for(spark, small_dir).invoice
    empty = inv.filter(F.col("count_invoice_record_line") == 0)
    assert empty.count() > 0
    assert empty.filter(F.size("json_invoice_record_line") != 1).count() == 0
    assert empty.filter(F.col("json_invoice_record_line")[0]["line_cnt"].isNotNull()).count() == 0


def test_vendor_name_is_first_address(spark, small_dir):
    v = marts_for(spark, small_dir).vendors
    assert v.filter(F.col("vendor_name") != F.col("vendor_record_address")[0]["addr1"]).count() == 0


def test_allocation_figures_at_sf001(spark):
    """
    §7.2, computed independently with integer cents)."""
    m = marts_for(spark, "/root/testdata/sf0.01")
    r = m.invoice_line_data.selectExpr(
        "count(*) lines", "count(distinct invoice_record_id) invoices",
        "sum(case when is_off then 1 else 0 end) off", "sum(case when is_off = false then 1 else 0 end) exact",
        "max(abs(off_amt_cents)) max_residual").first()
    assert (r.lines, r.invoices, r.off, r.exact, r.max_residual) == (49493, 6653, 3326, 3253, 320500017)
    h = m.invoice_header.selectExpr("count(*) n", "count(posted_date) posted").first()
    assert (h.n, h.posted) == (8352, 6753)


def test_allocation_independent_of_chunk_size(spark, small_dir):
    """The skew-safe running total gives the same rows whether an invoice is
    one chunk or many (chunks of 3 positions here)."""
    from procura.plans.marts import Marts
    from procura.sources.testdata import TestSources
    src = TestSources(spark, small_dir)
    a = Marts(src, materialize="none").invoice_line_data
    b = Marts(src, chunk_size=3, materialize="none").invoice_line_data
    assert b.count() == a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_long_parents_are_one_row(spark, small_dir):
    """A parent of 5 000 children is one row of each nested mart, and the
    look-ups count it once (Q3) or once per matching child (Q2)."""
    from decimal import Decimal

    from fakes import FakeSources

    from procura.plans import queries as Q
    from procura.plans.marts import Marts
    from procura.plans.reports import Reports
    n, order, vendor, inv, bib = 5_000, 2 << 56, 3 << 56, 1 << 56, 5 << 56
    meta = [{"id": i, "record_num": k, "record_type_code": c} for i, k, c in
            ((order, 7, "o"), (vendor, 8, "v"), (inv, 9, "n"), (bib, 6, "b"))]
    meta += [{"id": order + k, "record_num": 100 + k, "record_type_code": "o"} for k in range(1, n + 1)]
    orders = [{"record_id": order, "order_status_code": "o"}] + [
        {"record_id": order + k, "order_status_code": "f", "estimated_price": Decimal(1)} for k in range(1, n + 1)]
    kids = [{"id": k, "order_record_id": order, "display_order": 0, "fund_code": f"Brand#{k % 3}", "copies": 1,
             "location_code": "x"} for k in range(n)]
    kids += [{"id": n + k, "order_record_id": order + k, "display_order": 0, "fund_code": "none", "copies": 1,
              "location_code": "x"} for k in range(1, n + 1)]
    src = FakeSources(
        spark, small_dir, record_metadata=meta, order_record=orders, order_record_cmf=kids,
        bib_record_order_record_link=[{"order_record_id": order + k, "bib_record_id": bib} for k in range(n + 1)],
        order_status_property=[(1, "f")], order_status_property_name=[(1, "FULLY PAID")],
        fund_master=[{"id": k, "accounting_unit_id": 1, "code_num": k, "code": f"brd{k}"} for k in range(3)],
        vendor_record=[{"record_id": vendor, "code": "v"}], vendor_record_address_type=[(1, "a")],
        vendor_record_address=[{"id": k, "vendor_record_id": vendor, "vendor_record_address_type_id": 1} for k in range(n)],
        invoice_record=[{"id": inv, "record_id": inv}],
        invoice_record_line=[{"id": k, "invoice_record_id": inv, "line_cnt": k} for k in range(n)])
    m = Marts(src)
    big = m.orders.filter(F.col("order_record_num") == 7).collect()
    assert len(big) == 1 and big[0].count_cmf == len(big[0].cmf_data) == n
    for df, array in ((m.vendors, "vendor_record_address"), (m.invoice, "json_invoice_record_line"),
                      (Reports(m).fully_paid_order_bib_avg_item_cost_view, "order_dates")):
        assert [len(r[array]) for r in df.collect()] == [n]
    assert Q.on_order_by_fund(m, "brd1").count() == sum(k % 3 == 1 for k in range(n))
    assert Q.multi_fund_orders(m, 2, "o").count() == 1


def test_no_query_runs_a_job_before_an_action(spark, small_dir):
    from procura.plans.registry import QUERIES, ROUND_TRIPS
    sc = spark.sparkContext
    for name, query in QUERIES.items():
        if name not in ROUND_TRIPS:
            sc.setJobGroup(f"plan-{name}", name)
            query(spark, small_dir).schema  # noqa: B018
            # reading a file's schema is the only job a plan may start
            assert len(sc.statusTracker().getJobIdsForGroup(f"plan-{name}")) <= 20, name
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert sc._jsc.sc().getPersistentRDDs().size() == 0
