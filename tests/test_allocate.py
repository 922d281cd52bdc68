"""F6 allocation with residual: worked cases, traps T7/T16, and the chunked
running sum against a plain window on random data."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from procura.operators.allocate import allocate, running_sum, share_cents


def _alloc(spark, rows, chunk_size=4096):
    df = spark.createDataFrame(rows, "inv bigint, pos int, paid bigint, sub decimal(14,2), tot decimal(14,2)")
    out = allocate(df, "inv", "pos", "paid", "sub", "tot", chunk_size=chunk_size)
    return {(r.inv, r.pos): r for r in out.collect()}


def test_shares_add_up(spark):
    rows = [(1, 1, 1000, Decimal("60.00"), Decimal("61.00")), (1, 2, 2000, Decimal("60.00"), Decimal("61.00")),
            (1, 3, 3000, Decimal("60.00"), Decimal("61.00"))]
    got = _alloc(spark, rows)
    assert [got[(1, i)].approx_adj_amt for i in (1, 2, 3)] == [17, 33, 50]
    assert got[(1, 3)].off_amt_cents == 0 and got[(1, 3)].is_off is False
    assert got[(1, 1)].is_off is None and got[(1, 1)].off_amt_cents is None
    assert got[(1, 3)].total_lines == 3


def test_residual_on_last_line(spark):
    rows = [(2, i, 100, Decimal("3.00"), Decimal("3.10")) for i in (1, 2, 3)]
    got = _alloc(spark, rows)
    assert [got[(2, i)].approx_adj_amt for i in (1, 2, 3)] == [3, 3, 3]
    assert [got[(2, i)].running_adjusted_total_paid_cents for i in (1, 2, 3)] == [103, 206, 309]
    assert got[(2, 3)].is_off is True and got[(2, 3)].off_amt_cents == 1
    assert got[(2, 1)].is_off is None and got[(2, 2)].is_off is None


def test_zero_subtotal_gives_nulls(spark):
    rows = [(3, 1, 0, Decimal("0.00"), Decimal("5.00")), (3, 2, 0, Decimal("0.00"), Decimal("5.00"))]
    got = _alloc(spark, rows)
    for i in (1, 2):
        r = got[(3, i)]
        assert r.approx_adj_amt is None and r.running_adjusted_total_paid_cents is None
    assert got[(3, 2)].is_off is None and got[(3, 2)].off_amt_cents is None


def test_peers_share_running_total(spark):
    # default RANGE frame: equal positions are peers (values 1,2,3,4 with the
    # middle two tied give 1,6,6,10)
    df = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (1, 2, 3), (1, 3, 4)], "g int, o int, v int")
    got = sorted(r.s for r in running_sum(df, "g", "o", "v", "s").collect())
    assert got == [1, 6, 6, 10]


def test_two_identical_lines_merged_keep_count(spark):
    # merged rows carry a count: the line count is 2 but only one row exists,
    # so no row sits at position 2 and none is flagged last
    df = spark.createDataFrame([(9, 1, 500, Decimal("10.00"), Decimal("11.00"), 2)],
                               "inv bigint, pos int, paid bigint, sub decimal(14,2), tot decimal(14,2), n bigint")
    r = allocate(df, "inv", "pos", "paid", "sub", "tot", count_col="n").first()
    assert r.total_lines == 2 and r.is_off is None and r.off_amt_cents is None


def test_share_cents_rounding(spark):
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("3.00"), Decimal("3.10")),
                                (Decimal("-2.50"), Decimal("10.00"), Decimal("10.05")),
                                (None, Decimal("1.00"), Decimal("2.00"))],
                               "a decimal(12,2), s decimal(14,2), t decimal(14,2)")
    assert [r[0] for r in df.select(share_cents("a", "s", "t")).collect()] == [3, -1, None]


def test_chunked_running_sum_matches_window(spark):
    rnd = random.Random(7)
    rows = []
    for g in range(6):
        n = rnd.choice([1, 5, 40, 300])
        for _ in range(n):
            rows.append((g, rnd.randint(0, 60), rnd.choice([None, rnd.randint(-50, 50)])))
    df = spark.createDataFrame(rows, "g int, o int, v int")
    ref = df.withColumn("s", F.sum("v").over(Window.partitionBy("g").orderBy("o")))
    for cs in (1, 3, 7, 4096):
        got = running_sum(df, "g", "o", "v", "s", chunk_size=cs)
        key = lambda t: tuple((x is None, x or 0) for x in t)
        a = sorted(((r.g, r.o, r.v, r.s) for r in got.collect()), key=key)
        b = sorted(((r.g, r.o, r.v, r.s) for r in ref.collect()), key=key)
        assert a == b, cs


def test_whole_groups_have_the_figures_of_chunked_ones(spark):
    rnd = random.Random(11)
    rows = [(g, o, None if o == 3 else rnd.randint(-50, 50), 2) for g in (1, 2, None) for o in (None, 0, 1, 1, 3, 5, 9)]
    rows += [(4, 1, None, 1), (4, 2, None, 1)]
    df = spark.createDataFrame(rows, "g int, o int, v int, n int")
    chunked = running_sum(df, "g", "o", "v", "s", group_totals={"t": "n"}, chunk_size=2)
    whole = running_sum(df, "g", "o", "v", "s", group_totals={"t": "n"}, whole=True)
    assert sorted(map(repr, whole.select(chunked.columns).collect())) == sorted(map(repr, chunked.collect()))


def test_large_and_ordinary_invoices_are_allocated_alike(spark, small_dir, monkeypatch):
    from fakes import FakeSources

    from procura.plans import marts
    money = Decimal("10.00")
    invoices = [{"id": i, "record_id": i, "posted_data_gmt": dt.datetime(2020, 1, 1), "subtotal_amt": money,
                 "grand_total_amt": Decimal("11.00")} for i in (1, 2, 3)]
    lines = [{"id": 100 * i + k, "invoice_record_id": i, "line_cnt": None if k == 4 else k // 2, "paid_amt": Decimal(k)}
             for i, n in ((1, 12), (2, 5)) for k in range(n)]
    lines += [{"id": 900, "line_cnt": 0, "paid_amt": Decimal(1)}]  # of no invoice
    records = [{"id": i, "record_num": 1000 + i, "record_type_code": "n"} for i in (1, 2, 3)]

    def figures(chunks):
        monkeypatch.setattr(marts, "WHOLE_CHUNKS", chunks)
        src = FakeSources(spark, small_dir, invoice_record=invoices, invoice_record_line=lines, record_metadata=records)
        return sorted(map(repr, marts.Marts(src, chunk_size=2).invoice_line_data.collect()))

    whole, mixed, chunked = (figures(n) for n in (64, 4, 0))
    assert len(whole) == 17 and whole == mixed == chunked
