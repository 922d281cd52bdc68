"""Reshaping and look-up building blocks (melt, heading + detail union,
distinct concatenation, fallback look-up, code decoding)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def melt(df: DataFrame, id_vars: list[str], value_vars: list[str], var_name: str,
         value_name: str) -> DataFrame:
    """Wide to long: one row per (row, value column)."""
    return df.unpivot(id_vars, value_vars, var_name, value_name)


def with_headings(detail: DataFrame, heading: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Detail rows plus heading rows, matched by column name.  ``types`` casts
    columns on both sides first, for columns that hold different kinds of
    value in the two halves (a line number in one, a total in the other)."""
    types = types or {}

    def cast(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])

    return cast(detail).unionByName(cast(heading), allowMissingColumns=True)


def concat_distinct(col: str, sep: str = ", ") -> Column:
    """Aggregate: distinct non-null values joined by ``sep`` in sorted order
    (the order of a plain group concatenation is unspecified; sorting makes it
    deterministic)."""
    return F.array_join(F.array_sort(F.collect_set(F.col(col))), sep)


def fallback_lookup(df: DataFrame, key: Column, primary: DataFrame, secondary: DataFrame,
                    out: str) -> DataFrame:
    """``out`` = the primary look-up value for ``key``, else the secondary one.

    ``primary`` and ``secondary`` are (``k``, ``v``) frames with one row per
    key (deduplicate them first, e.g. with a first-by aggregate)."""
    p = primary.select(F.col("k").alias("_pk"), F.col("v").alias("_pv"))
    s = secondary.select(F.col("k").alias("_sk"), F.col("v").alias("_sv"))
    d = df.withColumn("_key", key)
    d = d.join(p, d._key == p._pk, "left").join(s, F.col("_key") == s._sk, "left")
    return d.withColumn(out, F.coalesce("_pv", "_sv")).drop("_key", "_pk", "_pv", "_sk", "_sv")


def decode(df: DataFrame, code_col: str, codes: DataFrame, out: str,
           code: str = "code", name: str = "name") -> DataFrame:
    """Replace a code by its name via a left join on a code table; unknown
    codes give null."""
    c = codes.select(F.col(code).alias("_dc"), F.col(name).alias(out))
    return df.join(c, F.col(code_col) == c._dc, "left").drop("_dc")
