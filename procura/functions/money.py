"""Money helpers.  Money is exact: decimals or integer cents, never doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_cents(col) -> Column:
    """Dollars to integer cents, rounding half away from zero (like a numeric
    to integer cast in PostgreSQL).  A plain cast would truncate."""
    c = _c(col)
    return F.round(c * F.lit(100), 0).cast("bigint")


def cents_to_money(col, precision: int = 14) -> Column:
    """Integer cents to exact decimal dollars with 2 decimals."""
    return (_c(col).cast(f"decimal({precision},0)") / F.lit(100)).cast(f"decimal({precision},2)")


def pct_of(num, den, scale: int = 2) -> Column:
    """Guarded percentage ``num / den * 100`` rounded half away from zero to
    ``scale`` decimals; 0 when the denominator is 0 or either side is null.

    Inputs are integer amounts (cents, counts).  The quotient is formed with
    exact integer arithmetic, so half-way cases round the same on every engine
    (rounding a double quotient is not portable)."""
    n = _c(num).cast("decimal(38,0)")
    d = _c(den).cast("decimal(38,0)")
    a = (F.abs(n) * F.lit(2 * 10 ** (scale + 2)) + F.abs(d)).cast("decimal(38,0)")
    b = (F.abs(d) * F.lit(2)).cast("decimal(38,0)")
    q = int_div(a, b)
    r = F.when(d == 0, F.lit(None)).when((n < 0) != (d < 0), -q).otherwise(q)
    out = (r.cast("decimal(38,0)") / F.lit(10 ** scale)).cast(f"decimal(18,{scale})")
    return F.coalesce(out, F.lit(0).cast(f"decimal(18,{scale})"))


def int_div(a: Column, b: Column) -> Column:
    """Exact integral division of non-negative integer-valued decimals."""
    return ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")
