"""Null-safe joins and skew-safe row numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null keys match null keys (``<=>``), as
    grouping does; the right side's key columns are dropped."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def join_clustered(left: DataFrame, right: DataFrame, cluster: str, keys: list[str], how: str = "left",
                   null_safe: bool = False) -> DataFrame:
    """Equi-join (``left`` or ``inner``) on ``cluster`` and ``keys`` of rows that
    both sides have dealt by ``cluster`` alone.  A plain join would deal all
    rows of both sides anew, by all its keys.  Here both are put together, and
    right rows reach the left ones of the same keys in a window, on the dealing
    they have (sides that are not dealt alike are dealt once, by all keys).  All
    rows of a ``cluster`` value meet in one task: for ordinary groups only.
    With ``null_safe`` a null key matches a null key."""
    on = [cluster, *keys]
    payload = [c for c in right.columns if c not in on]
    both = left.withColumn("_of_left", F.lit(True)).unionByName(
        right.select(*on, F.struct(*payload).alias("_right")), allowMissingColumns=True)
    equal = F.lit(True)
    for k in [] if null_safe else on:
        equal = equal & F.col(k).isNotNull()
    met = both.select(*left.columns, "_of_left", F.when(equal, F.collect_list("_right").over(Window.partitionBy(*on))).alias("_right"))
    each = F.explode_outer if how == "left" else F.explode
    d = met.filter("_of_left").select(*left.columns, each("_right").alias("_right"))
    return d.select(*left.columns, *[F.col(f"_right.{c}").alias(c) for c in payload])


#: Rows of a group that one task sorts; a larger group is worked on by chunks.
WHOLE_GROUP = 200_000


#: Marks that groups are dealt to by hash, to find the large ones.
SIZE_MARKS = 65_536


def large_groups(df: DataFrame, group: list[str], rows: int = WHOLE_GROUP) -> DataFrame:
    """Keys of the groups of more than ``rows`` rows.  There is at most one in
    ``rows`` rows, so the keys are broadcast and the rows stay where they are.
    Rows are counted by mark first, a bounded number of counts a task; groups
    are counted one by one only where a mark has more than ``rows`` rows."""
    d = df.select(*group, F.pmod(F.xxhash64(*group), F.lit(SIZE_MARKS)).alias("_mark"))
    counts = lambda g: g.agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > rows)
    marks = F.broadcast(counts(d.groupBy("_mark")).select(F.col("_mark").alias("_full")))
    full = d.join(marks, F.col("_mark") == F.col("_full"), "left_semi")
    return F.broadcast(counts(full.groupBy(*group)).select(*group))


def row_number_chunked(df: DataFrame, group: list[str], order: list[str], levels: list[Column],
                       out: str, zero_based: bool = False, whole: int = WHOLE_GROUP,
                       counted: DataFrame | None = None) -> DataFrame:
    """``row_number() over (partition by group order by order)`` without
    putting a group of more than ``whole`` rows into one task.

    The other groups are numbered by a plain window: one shuffle of the rows.
    ``counted`` are rows to find the large groups by, where these are cheaper
    to read than ``df`` and tell about as much; they never change a number.
    The rows of large groups are numbered by chunks.  ``levels`` are expressions, coarse to fine, that together never decrease
    along ``order`` inside a group (e.g. the day, then a range of the key
    within the day).  Rows are numbered inside their finest chunk.  A chunk's
    offset is the sum, over the levels, of the rows in earlier chunks of the
    same parent chunk, each from a table of counts one level up; so no task
    ever holds more than one finest chunk of rows, or the children of one
    chunk at one level - not all the chunks of a group, even where every row
    has a chunk of its own."""
    large = large_groups(df if counted is None else counted, group, whole)
    first = 1 if zero_based else 0
    rest = join_null_safe(df, large, group, "left_anti")
    rest = rest.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("bigint") - first)
    return rest.unionByName(_by_chunks(join_null_safe(df, large, group, "left_semi"), group, order, levels, out, first))


def _by_chunks(df: DataFrame, group: list[str], order: list[str], levels: list[Column], out: str, first: int) -> DataFrame:
    names = [f"_rn_{i}" for i in range(len(levels))]
    d = df.select("*", *[c.alias(n) for c, n in zip(levels, names)])
    counts = d.groupBy(*group, *names).agg(F.count(F.lit(1)).alias("_rn_n"))
    offsets = None
    for depth in range(len(names), 0, -1):
        parent, level = [*group, *names[:depth - 1]], names[depth - 1]
        before = Window.partitionBy(*parent).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
        here = counts.select(*parent, level, F.coalesce(F.sum("_rn_n").over(before), F.lit(0)).alias("_rn_here"))
        if offsets is None:
            offsets = here.withColumnRenamed("_rn_here", "_rn_off")
        else:
            offsets = (join_null_safe(offsets, here, [*parent, level])
                       .withColumn("_rn_off", F.col("_rn_off") + F.col("_rn_here")).drop("_rn_here"))
        counts = counts.groupBy(*parent).agg(F.sum("_rn_n").alias("_rn_n"))
    j = join_null_safe(d, offsets, [*group, *names])
    within = Window.partitionBy(*group, *names).orderBy(*order)
    rn = F.row_number().over(within) + F.col("_rn_off") - first
    return j.withColumn(out, rn).drop(*names, "_rn_off")
