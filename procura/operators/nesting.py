"""Nesting children into ordered arrays, unnesting them, first-by picks.

Arrays are native ``array<struct>`` columns; JSON text only appears at an
export boundary (:func:`to_json_text`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sort_struct(order: list[str], fields: list[str], nulls_first: bool = False) -> Column:
    """Struct whose leading fields give the wanted order: for every order
    column a null flag (nulls last, as in an ascending SQL sort, unless
    ``nulls_first``) and the value, then the payload fields."""
    keys = []
    for i, o in enumerate(order):
        flag = F.col(o).isNotNull() if nulls_first else F.col(o).isNull()
        keys += [flag.alias(f"_n{i}"), F.col(o).alias(f"_k{i}")]
    return F.struct(*keys, *[F.col(f).alias(f) for f in fields])


#: Positions whose children are sorted together.
NEST_CHUNK = 4096


def _flagged(cols: list[tuple[str, Column]], nulls_first: bool) -> list[Column]:
    """Sort keys for a struct: each value after a flag that puts its null last
    (first with ``nulls_first``)."""
    return [c for name, col in cols for c in ((col.isNotNull() if nulls_first else col.isNull()).alias(f"_f{name}"),
                                              col.alias(name))]


def nest_parts(df: DataFrame, keys: list[str], fields: list[str], order: list[str], chunks: list[Column],
               partial: dict[str, Column] | None = None, nulls_first: bool = False) -> DataFrame:
    """First level of :func:`nest`: one row per parent and chunk, with the
    chunk's children sorted (``_part``) and the ``partial`` aggregates."""
    chunk = [f"_c{i}" for i in range(len(chunks))]
    d = df.select("*", *[c.alias(n) for c, n in zip(chunks, chunk)])
    part = F.array_sort(F.collect_list(_sort_struct(order, fields, nulls_first)))
    g = d.groupBy(*keys, *chunk).agg(part.alias("_part"), *[c.alias(n) for n, c in (partial or {}).items()])
    # the sort keys stay behind: only the fields travel on
    return g.withColumn("_part", F.transform("_part", lambda s: F.struct(*[s[f].alias(f) for f in fields])))


def nest(df: DataFrame, key: str | list[str], fields: list[str], order: list[str], out: str,
         count_of: str | None = None, count_out: str | None = None,
         aggs: dict[str, tuple[Column, Column]] | None = None, nulls_first: bool = False,
         chunks: list[Column] | None = None) -> DataFrame:
    """One row per ``key`` with ``out`` = the rows' ``fields`` as an array of
    structs sorted by ``order`` (ascending, nulls last unless
    ``nulls_first``).  ``count_of`` adds ``count_out`` = number of non-null
    values of that column.  ``aggs`` adds further columns: name -> (aggregate
    of the rows of a chunk, aggregate of these over the parent's chunks, which
    reads them under the same name).

    Two levels: children are sorted inside chunks, and the sorted chunks of a
    parent are put one after another.  ``chunks`` are expressions, coarse to
    fine, that together never decrease along ``order`` (default: runs of
    ``NEST_CHUNK`` values of a first order column that is a number).  So a
    parent with a third of all children is collected and sorted by many tasks,
    and the task that makes its row sorts its chunks alone.

    One parent is one row at every size, whatever its number of children: a
    row is what a nested mart is made of, so a parent with more children than
    a row can hold fails.  Everything that must scale past that reads the flat
    form instead; no report reads a nested array.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if chunks is None:
        whole = df.schema[order[0]].dataType.typeName() in ("byte", "short", "integer", "long")
        chunks = [in_runs(order[0])] if whole else [F.lit(0)]
    levels = dict(aggs or {})
    if count_of:
        name = count_out or f"count_{count_of}"
        levels[name] = (F.count(count_of), F.sum(name).cast("bigint"))
    parts = nest_parts(df, keys, fields, order, chunks, {n: first for n, (first, _) in levels.items()}, nulls_first)
    chunk = [(f"_c{i}", F.col(f"_c{i}")) for i in range(len(chunks))]
    place = F.struct(*_flagged(chunk, nulls_first), F.col("_part").alias("_part"))
    g = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(place)).alias("_parts"),
                                 *[second.alias(n) for n, (_, second) in levels.items()])
    return g.withColumn(out, F.flatten(F.transform("_parts", lambda s: s["_part"]))).drop("_parts")


def in_runs(col: str, size: int = NEST_CHUNK) -> Column:
    """Chunk of a whole number: runs of ``size`` consecutive values."""
    return F.floor(F.col(col) / F.lit(size))


def unnest(df: DataFrame, array_col: str, fields: list[str] | None = None, prefix: str = "") -> DataFrame:
    """One row per array element; parents with an empty or null array drop
    out (inner unnest).  Element fields become columns."""
    e = df.select("*", F.explode(array_col).alias("_elem")).drop(array_col)
    names = fields if fields is not None else e.schema["_elem"].dataType.fieldNames()
    return e.select(*[c for c in e.columns if c != "_elem"],
                    *[F.col(f"_elem.{f}").alias(prefix + f) for f in names])


def first_by(value: str, order: list[str]) -> Column:
    """Aggregate: ``value`` of the row that sorts first by ``order``
    (ascending, nulls last) - the row a correlated ``ORDER BY .. LIMIT 1``
    would pick.  A null value on that row gives null (it is not skipped)."""
    key = F.struct(*[c for i, o in enumerate(order)
                     for c in (F.col(o).isNull().alias(f"_n{i}"), F.col(o).alias(f"_k{i}"))])
    return F.min_by(F.col(value), key)


def to_json_text(col: str) -> Column:
    """JSON text of a nested column, null fields kept (export boundary)."""
    return F.to_json(F.col(col), {"ignoreNullFields": "false"})
