"""Connected components of a stored edge list by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procura.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """Columns ``a`` and ``b`` (long ids, any order, repeats allowed) ->
    ``node``, ``root``: the smallest id reachable, for each node that is not
    itself the smallest.  Each round points the larger neighbours, then the
    smaller ones, of every node at its smallest neighbour; the rounds end when
    the edges no longer change (a logarithmic number of rounds).  All work is
    joins and partial aggregates; hot nodes are split by the skew join.
    """
    edges = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "edges")
    state = None
    while (now := _signature(edges)) != state:
        state = now
        if not now[0]:
            break
        both = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("low").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (large.join(least, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .union(least.toDF("a", "b")).distinct())
        edges = stage(small, "edges")
    return edges.toDF("node", "root")


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(r)
