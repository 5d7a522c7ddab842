"""What an indication's text says about its type, condition and population."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes of a condition, the first that fits is removed.
PREFIXES = ["prevents and treats", "treats", "for the treatment of", "indicated for", "used for", "prevention and treatment of"]
# Age patterns, in order.
AGES = [
    r"children (\d+) years? of age and older", r"adults and children (\d+) years? and older", r"children under (\d+) years?",
    r"ages? (\d+) and (?:older|above)", r"(\d+) years? and older",
]
# Words of use outside the section of indications.
USAGE = "treats|treatment|used for|indicated|relief"


def indication_type(c: Column) -> Column:
    return F.when(F.lower(c).rlike("prevent|prophylaxis|prophylactic"), F.lit("prevention")).otherwise(F.lit("primary"))


def condition_name(c: Column) -> Column:
    """The text without a known prefix, its first 100 characters; blank gives null."""
    t = F.trim(c)
    rest = F.when(F.lit(False), t)
    for p in PREFIXES:
        rest = rest.when(F.lower(t).startswith(p), F.trim(F.substring(t, len(p) + 1, 1_000_000)))
    return F.nullif(F.trim(F.substring(rest.otherwise(t), 1, 100)), F.lit(""))


def population(c: Column) -> Column:
    """``Age restriction found: ...``, Children and adults, Children, Adults or null."""
    t = F.lower(c)
    out = F.when(F.lit(False), t)
    for p in AGES:
        out = out.when(t.rlike(p), F.concat(F.lit("Age restriction found: "), F.regexp_extract(t, f"({p})", 1)))
    child, adult = t.contains("children"), t.contains("adult")
    return out.when(child & adult, F.lit("Children and adults")).when(child, F.lit("Children")).when(adult, F.lit("Adults"))


def mentions_use(c: Column) -> Column:
    return F.lower(c).rlike(USAGE) & (F.length(F.trim(c)) > 10)
