"""National drug codes: validity, normal form, parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digit groups of full and of product-level codes.
FULL = [(4, 4, 2), (5, 3, 2), (5, 4, 1), (6, 3, 2)]
PARTIAL = [(4, 4), (5, 3), (5, 4), (6, 3)]
IN_TEXT = r"(?i)\b(?:NDC[:\s]*)?(\d{4,6}[-\s]?\d{3,4}[-\s]?\d{1,2})\b"


def _shape(groups: list[tuple[int, ...]]) -> str:
    return "^(?:" + "|".join("-".join(rf"\d{{{n}}}" for n in g) for g in groups) + ")$"


def clean_ndc(c: Column) -> Column:
    """Without the letters NDC, hyphens and blanks."""
    return F.regexp_replace(F.regexp_replace(F.trim(c), r"(?i)^NDC[:\s]*", ""), r"[-\s]", "")


def is_partial_ndc(c: Column) -> Column:
    """A product-level code without package part."""
    return c.rlike(_shape(PARTIAL))


def _sound(d: Column) -> Column:
    varied = F.length(F.replace(d, F.substring(d, 1, 1), F.lit(""))) > 0
    parts = (F.length(d) != 10) | ((F.substring(d, 1, 5) != "00000") & (F.substring(d, 6, 4) != "0000"))
    return varied & parts


def is_valid_ndc(c: Column) -> Column:
    """Ten or eleven sound digits, one of the hyphenated shapes, or a product-level code; false for null."""
    d = clean_ndc(c)
    digits = d.rlike(r"^\d{10,11}$")
    return F.coalesce(is_partial_ndc(c) | (F.when(digits, _sound(d)).otherwise(c.rlike(_shape(FULL)))), F.lit(False))


def normalize_ndc(c: Column) -> Column:
    """5-4-1 form; product-level codes stay; eleven digits only with a leading 0; else null."""
    d = clean_ndc(c)
    ten = F.when(F.length(d) == 10, d).when((F.length(d) == 11) & d.startswith("0"), F.substring(d, 2, 10))
    full = F.concat_ws("-", F.substring(ten, 1, 5), F.substring(ten, 6, 4), F.substring(ten, 10, 1))
    return F.when(is_valid_ndc(c), F.when(is_partial_ndc(c), c).when(ten.isNotNull(), full))


def ndc_components(c: Column) -> Column:
    """struct(labeler, product, package) of the normal form; null for product-level codes."""
    p = F.split(normalize_ndc(c), "-")
    return F.when(F.size(p) == 3, F.struct(p[0].alias("labeler"), p[1].alias("product"), p[2].alias("package")))


def extract_ndcs(c: Column) -> Column:
    """Distinct normal codes in a text, in order; empty for null."""
    found = F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(IN_TEXT), F.lit(1)), normalize_ndc)
    return F.array_distinct(F.filter(found, lambda x: x.isNotNull()))


def is_valid_labeler(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^\d{5}$") & (c != "00000"), F.lit(False))


def hyphenated_ndc(c: Column) -> Column:
    """The second, simpler reading: 5-4-1 of ten digits, 5-4-2 of eleven, else null."""
    d = clean_ndc(c)
    return F.when(d.rlike(r"^\d{10,11}$"), F.concat_ws("-", F.substring(d, 1, 5), F.substring(d, 6, 4), F.substring(d, 10, 2)))


def valid_ndcs(codes: Column) -> Column:
    """Distinct normal forms of the valid codes of an array."""
    return F.array_distinct(F.filter(F.transform(codes, normalize_ndc), lambda x: x.isNotNull()))


def invalid_ndcs(codes: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(codes, lambda x: ~is_valid_ndc(x))))
