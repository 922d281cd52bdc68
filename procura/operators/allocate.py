"""Proportional allocation of an invoice-level charge over its lines.

The difference between an invoice's grand total and its subtotal (tax,
shipping, discounts) is spread over the lines in proportion to each line's
paid amount.  Each share is rounded, so the rounded shares need not add up to
the difference; a running total per invoice shows how far the last line is
off, and that residual is added to the last line on export.

Scale design
------------
A running total is a window ordered inside each invoice.  A plain
``Window.partitionBy(invoice)`` puts every line of an invoice into one task, so
a single huge invoice (a third of all rows, say) would become one straggler
task holding a third of the data.  :func:`running_sum` therefore splits every
group into chunks of ``chunk_size`` consecutive order values:

1. per ``(group, chunk)`` partial sums and counts - an ordinary aggregation
   with map-side partial aggregation, so hot groups are pre-aggregated before
   the shuffle;
2. an exclusive prefix over the (much smaller) chunk table per group;
3. a join back on ``(group, chunk)`` and a window per ``(group, chunk)``.

The biggest window partition is one chunk, whatever the size of the group.
Groups known to be small (``whole``) need no chunks: one plain window adds them
up, on the clustering by group that their rows have from the join before.
Equal order values always fall into the same chunk, so the SQL default frame
(RANGE: peers share the same running total) is kept exactly, and so is SUM's
null behaviour (null only while no non-null value has been seen).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from procura.operators.sizing import join_null_safe

DEFAULT_CHUNK_SIZE = 4096


def share_cents(amount, subtotal, total) -> Column:
    """Share, in integer cents, of ``total - subtotal`` for a line of ``amount``.

    ``round(round(amount / nullif(subtotal, 0), 6) * (coalesce(total, 0) -
    coalesce(subtotal, 0)), 2)`` in dollars, then to cents.  Null when the
    subtotal is 0 or null.  Every operand is bounded to an exact decimal type
    first, so no intermediate result loses scale (Spark reduces the scale of
    decimal products beyond precision 38, which would round twice).
    """
    c = lambda x: F.col(x) if isinstance(x, str) else x
    amt = c(amount).cast("decimal(12,2)")
    sub = c(subtotal).cast("decimal(14,2)")
    tot = c(total).cast("decimal(14,2)")
    ratio = F.round(amt / F.nullif(sub, F.lit(0).cast("decimal(14,2)")), 6).cast("decimal(22,6)")
    diff = (F.coalesce(tot, F.lit(0).cast("decimal(14,2)"))
            - F.coalesce(sub, F.lit(0).cast("decimal(14,2)"))).cast("decimal(15,2)")
    return (F.round(ratio * diff, 2) * F.lit(100)).cast("bigint")


def with_chunk(df: DataFrame, group: list[str] | str, order: str,
               chunk_size: int = DEFAULT_CHUNK_SIZE, repartition: bool = False) -> DataFrame:
    """Add the chunk number of every row; with ``repartition`` also
    hash-partition by ``(group, chunk)`` so that later steps keyed on a
    superset of these columns need no shuffle of their own."""
    group = [group] if isinstance(group, str) else list(group)
    d = df.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk_size)).cast("bigint"))
    return d.repartition(*group, "_chunk") if repartition else d


def running_sum(df: DataFrame, group: list[str] | str, order: str, value: str, out: str,
                group_totals: dict[str, str] | None = None,
                chunk_size: int = DEFAULT_CHUNK_SIZE, whole: bool = False) -> DataFrame:
    """Add ``out`` = SUM(value) OVER (PARTITION BY group ORDER BY order) with
    the default RANGE frame, computed skew-safely (see module docstring).

    ``order`` must be an integral column.  ``group_totals`` maps new column
    names to columns whose whole-group sum is wanted as well (taken from the
    chunk table, so it costs no extra pass over the rows).  If ``df`` already
    went through :func:`with_chunk` it is not shuffled again.  ``whole`` says
    that every group is small enough for one task.
    """
    group = [group] if isinstance(group, str) else list(group)
    group_totals = group_totals or {}
    if whole:
        so_far = Window.partitionBy(*group).orderBy(F.col(order).asc_nulls_last())  # default frame: RANGE .. CURRENT ROW
        return df.select("*", *[F.sum(src).over(Window.partitionBy(*group)).alias(name) for name, src in group_totals.items()],
                         F.sum(value).over(so_far).alias(out))
    keys = group + ["_chunk"]
    d = df if "_chunk" in df.columns else with_chunk(df, group, order, chunk_size, repartition=True)

    # the rows and their chunk table both read the same (group, chunk)
    # clustering: the per-chunk aggregate and the join back reuse it
    aggs = [F.sum(value).alias("_cs"), F.count(value).alias("_cc")]
    aggs += [F.sum(src).alias(f"_t_{name}") for name, src in group_totals.items()]
    per_chunk = d.groupBy(*keys).agg(*aggs)

    # rows without a position come last, as in an ascending SQL sort
    before = (Window.partitionBy(*group).orderBy(F.col("_chunk").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    whole = Window.partitionBy(*group)
    offsets = per_chunk.select(
        *keys,
        F.sum("_cs").over(before).alias("_off_s"),
        F.sum("_cc").over(before).alias("_off_c"),
        *[F.sum(f"_t_{name}").over(whole).alias(name) for name in group_totals])

    j = join_null_safe(d, offsets, keys)
    within = Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last())  # default frame: RANGE .. CURRENT ROW
    seen = F.coalesce(F.col("_off_c"), F.lit(0)) + F.count(value).over(within)
    total = F.coalesce(F.col("_off_s"), F.lit(0)) + F.coalesce(F.sum(value).over(within), F.lit(0))
    return (j.withColumn(out, F.when(seen == 0, F.lit(None)).otherwise(total))
            .drop("_chunk", "_off_s", "_off_c"))


def allocate(lines: DataFrame, group: list[str] | str, order: str, amount_cents: str,
             subtotal: str, total: str, *, line_count: str = "total_lines",
             count_col: str | None = None, chunk_size: int = DEFAULT_CHUNK_SIZE, whole: bool = False) -> DataFrame:
    """Spread ``total - subtotal`` over the lines of each group.

    ``lines`` has one row per line with the line amount in cents
    (``amount_cents``) and the group's ``subtotal`` / ``total`` as decimal
    money.  ``order`` is the 1-based line position; the last line is the one
    whose position equals the group's line count.  ``count_col`` (optional)
    is the number of source lines a row stands for (when identical lines were
    merged); the line count is the sum of it, else the number of rows.
    ``whole``: see :func:`running_sum`.

    Adds: ``approx_adj_amt`` (share in cents), ``running_adjusted_total_paid_cents``,
    ``line_count``, ``is_off`` (only on the last line: does the running total
    miss the grand total?) and ``off_amt_cents`` (residual, last line only).
    """
    amount = (F.col(amount_cents).cast("decimal(12,0)") / F.lit(100)).cast("decimal(12,2)")
    d = lines.withColumn("approx_adj_amt", share_cents(amount, subtotal, total))
    d = d.withColumn("_v", F.col(amount_cents) + F.col("approx_adj_amt"))
    d = d.withColumn("_n", F.col(count_col) if count_col else F.lit(1).cast("bigint"))
    d = running_sum(d, group, order, "_v", "running_adjusted_total_paid_cents",
                    group_totals={line_count: "_n"}, chunk_size=chunk_size, whole=whole).drop("_v", "_n")
    grand_cents = (F.col(total).cast("decimal(14,2)") * 100).cast("bigint")
    last = F.col(order) == F.col(line_count)
    running = F.col("running_adjusted_total_paid_cents")
    d = d.withColumn("is_off", F.when(~last, F.lit(None).cast("boolean"))
                     .when(last & (running != grand_cents), F.lit(True))
                     .when(last & (running == grand_cents), F.lit(False)))
    d = d.withColumn("off_amt_cents", F.when(last, grand_cents - running))
    return d
