"""Text keys and normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def digits_key(col) -> Column:
    """Join key made of the digits of a code: drop every non-digit, empty text
    becomes null, the rest an integer (``'Brand#13'`` -> 13, ``'none'`` -> null)."""
    digits = F.regexp_replace(_c(col), r"[^0-9]", "")
    return F.when(digits == "", F.lit(None)).otherwise(digits).try_cast("bigint")


def int_prefix(col) -> Column:
    """Integer value of the leading number of a text, the way a lenient
    text-to-integer cast reads it: surrounding blanks ignored, optional sign,
    digits up to the first non-digit; no leading digits gives 0; null stays null.
    Values beyond the 64-bit range clamp to the largest / smallest bigint."""
    c = _c(col)
    m = F.regexp_extract(F.ltrim(c), r"^[+-]?[0-9]+", 0)
    parsed = m.try_cast("bigint")
    neg = m.startswith("-")
    clamped = F.when(neg, F.lit(-(2 ** 63))).otherwise(F.lit(2 ** 63 - 1))
    value = (F.when(m == "", F.lit(0).cast("bigint"))
             .when(parsed.isNull(), clamped)
             .otherwise(parsed))
    return F.when(c.isNull(), F.lit(None).cast("bigint")).otherwise(value)


def strip_zeros_if_numeric(col) -> Column:
    """Invoice reference normalisation: drop leading zeros when the text reads
    as a number.  The rule is "the length of the integer read from the text
    equals the length of the text without leading zeros"; this keeps
    ``00890CO22422086`` and ``0000`` as they are and turns ``0001234`` into
    ``1234`` (and, as a side effect of the rule, ``0A`` into ``A``)."""
    c = _c(col)
    stripped = F.regexp_replace(c, r"^0+", "")
    n = F.length(int_prefix(c).cast("string"))
    return F.when(n == F.length(stripped), stripped).otherwise(c)
