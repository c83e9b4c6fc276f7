"""Casts of untrusted text. A bad token becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The token patterns of the sales feed. "12." , "-3", "1e3" and
# " 12" are meant to fail; Java's "$" also matches before one final newline.
WHOLE = r"^\d+$"
DECIMAL = r"^\d*\.?\d+$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"

SALE_CLEANING = {
    "id": (WHOLE, "bigint"),
    "prixUnitaire": (DECIMAL, "double"),
    "quantite": (WHOLE, "int"),
    "total": (DECIMAL, "double"),
    "remise": (DECIMAL, "double"),
    "dateVente": (ISO_DATE, "date"),
}

# Everything a cast from text to a whole number can accept.
_MAYBE_WHOLE = r"^[\x00-\x20\x7f]*[+-]?\d+[\x00-\x20\x7f]*$"


def lenient_cast(value: Column, from_type: T.DataType, to: str) -> Column:
    """``try_cast`` that keeps plain bad text out of the cast, where it costs an exception."""
    if isinstance(from_type, T.StringType) and to in ("tinyint", "smallint", "int", "bigint"):
        value = F.when(value.rlike(_MAYBE_WHOLE), value)
    return value.try_cast(to)


def guarded_cast(token: Column, pattern: str, to: str) -> Column:
    """The token cast to ``to`` if it matches ``pattern`` and is in range, else NULL."""
    return F.when(token.rlike(pattern), token.try_cast(to))
