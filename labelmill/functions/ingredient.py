"""Ingredient names, codes and types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class codes.
CLASS_CODES = {"ACTIM": "active", "ACTIB": "active", "IACT": "inactive", "INACT": "inactive"}

# Endings that don't belong to a name, in order.
TAILS = [
    r"\s+\(UNII:\s*[A-Z0-9]+\)$",
    r"\s+\[INN\]$",
    r"\s+\[USP\]$",
]


def ingredient_type(class_code: Column) -> Column:
    """active, inactive, or null for other codes."""
    return F.try_element_at(F.create_map(*[F.lit(x) for p in CLASS_CODES.items() for x in p]), F.upper(class_code))


def normalize_substance(c: Column) -> Column:
    """Upper case, white space collapsed, without a final ``(UNII: X)``, ``[INN]``, ``[USP]``."""
    t = F.upper(F.trim(F.regexp_replace(c, r"\s+", " ")))
    for tail in TAILS:
        t = F.regexp_replace(t, tail, "")
    return F.trim(t)


def normalize_unii(c: Column) -> Column:
    """Ten letters and digits in upper case, else null."""
    t = F.upper(F.trim(c))
    return F.when(t.rlike(r"^[A-Z0-9]{10}$"), t)


def is_valid_substance(c: Column) -> Column:
    """Two characters at least, not digits only, not signs only; false for null."""
    t = F.trim(c)
    return F.coalesce((F.length(t) >= 2) & ~t.rlike(r"^[\d\s]+$") & ~t.rlike(r"^[^\p{L}\p{N}]+$"), F.lit(False))
