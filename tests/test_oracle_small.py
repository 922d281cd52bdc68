"""Every registered query against its DuckDB oracle on the smallest test
tables (brute force: whole tables, all rows compared as multisets).  Queries
over stored tables are compared with the plain ones in test_ledger_store.py;
here one of either kind stands for them."""

import pytest

import __spark_entry__ as E
from procura.checks.compare import compare, duck_connection

from procura.plans.registry import QUERIES

STORED = {n for n in QUERIES if n.endswith(("_bucketed", "_published"))}
NAMES = sorted(set(QUERIES) - STORED | {"ledger_export_distinct_bucketed", "report_top_published"})


@pytest.fixture(scope="module")
def con(small_dir):
    return duck_connection(small_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, small_dir, name):
    r = compare(E.queries()[name](spark, small_dir), con, E.oracle_sql()[name])
    assert r["columns_equal"], r
    assert not r["type_diff"], r
    assert r["rows"][0] == r["rows"][1], r
    assert r["values_equal"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "running_adjusted_total_paid_cents" in df.columns
