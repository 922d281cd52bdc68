"""Pure Column -> Column helpers (all built-in Spark expressions, no UDFs)."""

from procura.functions.money import cents_to_money, pct_of, to_cents
from procura.functions.text import digits_key, int_prefix, strip_zeros_if_numeric
from procura.functions.codes import GL_OBJECT_DESCRIPTIONS, gl_object_description

__all__ = [
    "to_cents", "cents_to_money", "pct_of",
    "digits_key", "int_prefix", "strip_zeros_if_numeric",
    "GL_OBJECT_DESCRIPTIONS", "gl_object_description",
]
