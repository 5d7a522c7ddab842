"""Dates as typed, to ISO dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats tried in this order. One-letter fields take one or two digits.
FORMATS = [
    "yyyyMMdd", "yyyy-M-d", "M/d/yyyy", "M-d-yyyy", "d/M/yyyy", "yyyy/M/d", "yyyy.M.d", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy",
    "yyyy-MM-dd'T'HH:mm:ss", "yyyyMMddHHmmss", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss",
]
# Names of the months; each is also known by its first three letters.
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
MONTHS = "|".join([*MONTH_NAMES, *[m[:3] for m in MONTH_NAMES]])
# Kinds of dates searched in a text, in this order, with their formats.
IN_TEXT = [
    (r"\b(\d{8})\b", ["yyyyMMdd"]),
    (r"\b(\d{4}-\d{2}-\d{2})\b", ["yyyy-M-d"]),
    (r"\b(\d{1,2}/\d{1,2}/\d{4})\b", ["M/d/yyyy", "d/M/yyyy"]),
    (r"\b(\d{1,2}-\d{1,2}-\d{4})\b", ["M-d-yyyy"]),
    (rf"(?i)\b((?:{MONTHS})\s+\d{{1,2}},?\s+\d{{4}})\b", ["MMMM d, yyyy", "MMM d, yyyy"]),
]


def _parse(c: Column, formats: list[str]) -> Column:
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)).cast("date") for f in formats])


def extract_date(c: Column) -> Column:
    """The first date of the first kind that is found in a text, by kind and not by place; else null."""
    return F.coalesce(*[_parse(F.nullif(F.regexp_extract(c, p, 1), F.lit("")), fs) for p, fs in IN_TEXT])


def normalize_date(c: Column) -> Column:
    """yyyy-MM-dd of a date in any known format, else of one found in the text, else null."""
    t = F.trim(c)
    return F.date_format(F.coalesce(_parse(t, FORMATS), extract_date(t)), "yyyy-MM-dd")


def is_iso_date(c: Column) -> Column:
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-M-d")).isNotNull() & c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.lit(False))


def is_future_date(c: Column, as_of: Column) -> Column:
    """After ``as_of``; false for what isn't a date."""
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-M-d")).cast("date") > as_of, F.lit(False))


def is_reasonable_drug_date(c: Column, as_of: Column) -> Column:
    """From 1950 to five years after ``as_of``."""
    year = F.year(F.try_to_timestamp(c, F.lit("yyyy-M-d")))
    return F.coalesce((year >= 1950) & (year <= F.year(as_of) + 5), F.lit(False))
