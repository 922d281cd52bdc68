"""Summarise the executed physical plan of every registered query.

    python tools/plans.py [sf_dir] > PLANS.md

For each query: shuffles (exchanges), broadcast / sort-merge joins, windows,
aggregates, cached reads, and whether the parquet scans carry pushed filters
and a pruned read schema.  Queries run through the noop sink first, so the
numbers describe the final adaptive plan.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from procura.session import build_session  # noqa: E402


def _walk(node):
    """Nodes of the final physical plan: adaptive plans are followed into
    their final plan and query stages into their exchanges; cached relations
    (computed once by an earlier job) and reused exchanges are not entered."""
    cls = node.getClass().getSimpleName()
    if cls == "AdaptiveSparkPlanExec":
        yield from _walk(node.executedPlan())
        return
    if cls.endswith("QueryStageExec"):
        yield from _walk(node.plan())
        return
    yield node
    if cls in ("InMemoryTableScanExec", "ReusedExchangeExec"):
        return
    kids = node.children()
    for i in range(kids.size()):
        yield from _walk(kids.apply(i))


def summarise(plan) -> dict:
    nodes = [(n.getClass().getSimpleName(), n) for n in _walk(plan)]

    def count(*classes: str) -> int:
        return sum(1 for c, _ in nodes if c in classes)

    scans = [n for c, n in nodes if c == "FileSourceScanExec"]

    def pushed(n) -> bool:
        f = n.metadata().get("PushedFilters")
        return f.isDefined() and f.get() not in ("[]", "")

    return {
        "shuffles": count("ShuffleExchangeExec"),
        "broadcasts": count("BroadcastExchangeExec"),
        "bhj": count("BroadcastHashJoinExec"),
        "smj": count("SortMergeJoinExec", "ShuffledHashJoinExec"),
        "windows": count("WindowExec"),
        "aggregates": count("HashAggregateExec", "ObjectHashAggregateExec", "SortAggregateExec"),
        "cached": count("InMemoryTableScanExec"),
        "scans": len(scans),
        "scans_pushed": sum(1 for n in scans if pushed(n)),
        "cartesian": count("CartesianProductExec", "BroadcastNestedLoopJoinExec"),
        "python": count("BatchEvalPythonExec", "ArrowEvalPythonExec", "FlatMapGroupsInPandasExec",
                        "MapInPandasExec"),
    }


FLAGSHIP = """## Flagship walk-through: invoice line allocation (M5)

Executed plan over stored sources (sf0.1, `local[8]`), bottom-up:

1. Scans read only the needed columns with pushed filters: invoice headers
   (`posted_data_gmt is not null`), invoice record numbers
   (`record_type_code = 'n'`), lines (`invoice_record_id, line_cnt, paid_amt`).
2. Header and metadata joins are equi-joins on the invoice id (broadcast by
   AQE when a side is small, otherwise shuffle joins whose skewed partitions
   AQE splits).
3. Identical (paid amount, position) lines are merged by a hash aggregate
   keyed on (invoice, chunk, position, ...): partial aggregation before the
   shuffle, a hot invoice spreads over all its chunks.  One repartition by
   (invoice, chunk) before the merge serves it and both following branches.
4. Chunk table: partial + final aggregate per (invoice, chunk) (sum, count,
   line count), then a window per invoice over the chunk rows only
   (exclusive prefix sum and whole-invoice line count).
5. Rows join their chunk's offsets on (invoice, chunk) (sort-merge on the
   composite key: no single invoice lands in one task), then a RANGE window
   per (invoice, chunk) ordered by position finishes the running total.

The largest window partition is one chunk of 4096 positions whatever the
invoice size; there is no Python, no cartesian product, no global sort.
"""


def _table(spark, runs) -> None:
    cols = ["shuffles", "broadcasts", "bhj", "smj", "windows", "aggregates", "cached", "scans", "scans_pushed",
            "cartesian", "python"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name, make in runs:
        df = make()
        df.write.format("noop").mode("overwrite").save()
        s = summarise(df._jdf.queryExecution().executedPlan())
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")


def main() -> None:
    import tempfile

    from procura.plans.marts import Marts
    from procura.sources.catalog import SourceCatalog, export_sources
    from procura.sources.testdata import TestSources

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    from procura.plans.registry import QUERIES, ROUND_TRIPS
    qs = sorted((n, f) for n, f in QUERIES.items() if n not in ROUND_TRIPS)
    print(f"# Executed plans of the registered queries ({os.path.basename(sf_dir)}, local[8], AQE on)\n")
    print("Generated by `python tools/plans.py`.  Counts are operators of the final adaptive plan of each "
          "query (walked as a tree; reused exchanges count once).  `cartesian` counts cartesian products and "
          "nested-loop joins, `python` any Python evaluation; both must be 0.  The operators of the optional "
          "subpackage are not listed (README has their measured figures).\n")
    print(FLAGSHIP)
    print("## Production shape: sources stored as parquet\n")
    print("The marts and reports over stored source tables (what `refresh()` and `bench.py` run).\n")
    root = tempfile.mkdtemp(prefix="procura-plans-")
    export_sources(TestSources(spark, sf_dir), root)
    _table(spark, [(n, lambda f=f: f.on_marts(Marts(SourceCatalog.parquet(spark, root))))
                   for n, f in qs])
    print("\n## Over tables as a refresh publishes them\n")
    print("The ledgers over bucketed tables (`*_bucketed`), the first page, the facet and the look-ups over published "
          "tables (`*_published`); writing the tables is not counted.\n")
    _table(spark, [(n, lambda n=n: QUERIES[n].on_marts(Marts(SourceCatalog.parquet(spark, root))))
                   for n in sorted(ROUND_TRIPS) if n.endswith(("_bucketed", "_published"))])
    print("\n## Registered form: sources derived from the test tables in the same plan\n")
    print("Includes the test-table mapping (joins, chunked numbering, aggregates).\n")
    _table(spark, [(n, lambda f=f: f(spark, sf_dir)) for n, f in qs])
    spark.stop()


if __name__ == "__main__":
    main()
