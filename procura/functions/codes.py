"""Code descriptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# General-ledger object code -> description of the ledger line.
GL_OBJECT_DESCRIPTIONS = {
    5410: "PRINT MATERIALS",
    5420: "PERIODICALS",
    5430: "A/V LIBRARY MATERIALS",
    5450: "ELECTRONIC MATERIALS",
    5210: "ADMIN SUPPLIES",
}


def gl_object_description(col) -> Column:
    """Description for a GL object code; null for any other code."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for code, text in GL_OBJECT_DESCRIPTIONS.items():
        expr = (F.when(c == code, F.lit(text)) if expr is None else expr.when(c == code, F.lit(text)))
    return expr
