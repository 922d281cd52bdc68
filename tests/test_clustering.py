"""Lines stay where they were dealt by invoice: what they meet comes to them,
and all readers of a plan read one shuffle of the lines."""

import random
import re

import pytest
from pyspark.sql import functions as F

from procura.operators import sizing
from procura.operators.sizing import join_clustered, large_groups
from procura.plans.registry import QUERIES

PLAIN = "spark.sql.autoBroadcastJoinThreshold"


def _rows(df):
    return sorted(map(repr, df.collect()))


def _random(spark, seed, n, value):
    rnd = random.Random(seed)
    key = lambda m: rnd.choice([None, *range(m)])
    return spark.createDataFrame([(key(3), key(4), i) for i in range(n)], f"g long, k int, {value} int")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_join_clustered_is_a_join(spark, how):
    # keys repeat on both sides, and are null
    a, b = _random(spark, 1, 60, "a"), _random(spark, 2, 25, "b")
    want = a.join(b, ["g", "k"], how).select("g", "k", "a", "b")
    assert _rows(join_clustered(a, b, "g", ["k"], how)) == _rows(want)
    r = b.toDF("_g", "_k", "b")
    equal = a.g.eqNullSafe(r._g) & a.k.eqNullSafe(r._k)
    assert _rows(join_clustered(a, b, "g", ["k"], how, null_safe=True)) == _rows(a.join(r, equal, how).drop("_g", "_k"))


def test_join_clustered_leaves_rows_where_they_are(spark):
    a, b = (_random(spark, s, 500, v).repartition("g") for s, v in ((1, "a"), (2, "b")))
    d = join_clustered(a, b, "g", ["k"])
    d.collect()
    final = d._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") == 2, final


@pytest.mark.parametrize("marks", [1, 3, 65_536])
def test_large_groups_are_found_by_mark(spark, monkeypatch, marks):
    monkeypatch.setattr(sizing, "SIZE_MARKS", marks)
    df = spark.range(0, 1150, 1, 4).selectExpr(
        "case when id < 1000 then 0 when id < 1100 then 1 when id < 1110 then 2 end as g")
    for rows, want in ((0, {0, 1, 2, None}), (10, {0, 1, None}), (40, {0, 1}), (100, {0}), (1000, set())):
        assert {r.g for r in large_groups(df, ["g"], rows).collect()} == want


@pytest.mark.parametrize("name", ["invoice_nested_inner", "facet_counts"])
def test_lines_meet_their_parts_and_are_dealt_by_invoice_once(spark, small_dir, name):
    before = spark.conf.get(PLAIN)
    spark.conf.set(PLAIN, "-1")
    try:
        df = QUERIES[name](spark, small_dir)
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set(PLAIN, before)
    for key in ("l_partkey", "order_record_metadata_id"):
        ids = set(re.findall(rf"Exchange hashpartitioning\({key}#\d+L?, \d+\).*?plan_id=(\d+)", final))
        assert len(ids) == (key == "l_partkey"), (key, ids)


def test_lines_of_no_invoice_are_in_no_ledger_table(spark, small_dir):
    from procura.plans.ledger_store import ledger_lines
    from procura.plans.marts import Marts
    from procura.plans.reports import Reports
    from tests.fakes import FakeSources
    src = FakeSources(spark, small_dir, invoice_record=[{"id": None, "record_id": None}, {"id": 1, "record_id": 1}],
                      invoice_record_line=[{"id": 5, "invoice_record_id": 1, "line_cnt": 0}, {"id": 6, "line_cnt": 0}])
    assert [r.invoice_record_id for r in ledger_lines(Reports(Marts(src))).collect()] == [1]
