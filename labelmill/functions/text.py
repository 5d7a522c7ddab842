"""Text cleaning as column expressions. Null stays null unless a function says otherwise."""

from __future__ import annotations

import html
import html.entities
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space of any alphabet, spelled out so that Java, RE2 and Python agree.
SPACE = r"[\s\x{00A0}\x{2000}-\x{200A}\x{202F}\x{3000}]"
# Entities decoded first, in this order, before the full table.
ENTITIES = [
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&quot;", '"'), ("&apos;", "'"), ("&deg;", "°"), ("&micro;", "μ"), ("&plusmn;", "±"),
]
# List marks at a line's start, tried in this order.
BULLETS = [r"[•·∙▪▫◦‣⁃]", r"[-*+]", r"\d+\.", r"[a-zA-Z]\."]
BLOCK_TAGS = r"(?i)</?(?:div|p|br|li|ul|ol)[^>]*>"
ANY_TAG = r"<[^>]+>"


def collapse(c: Column) -> Column:
    """Runs of white space become one blank, outer ones go."""
    return F.trim(F.regexp_replace(c, SPACE + "+", " "))


def decode_entities(c: Column, passes: int = 2) -> Column:
    """The nine common entities, in order and twice (so ``&amp;lt;`` gives ``<``); stays on the JVM."""
    for entity, sign in ENTITIES * passes:
        c = F.replace(c, F.lit(entity), F.lit(sign))
    return c


@F.pandas_udf(T.StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else html.unescape(t))


def decode_all_entities(c: Column) -> Column:
    """The common entities, then the full HTML table where an entity is left (Arrow-batched)."""
    c = decode_entities(c, passes=1)
    return F.when(c.contains("&"), _unescape(c)).otherwise(c)


#: Names of all HTML entities that end in a semicolon -> their signs.
NAMED = {name.removesuffix(";"): sign for name, sign in html.entities.html5.items() if name.endswith(";")}


def unescape(c: Column) -> Column:
    """Entities decoded once, by the full HTML table and by number; unknown ones stay. On the JVM.

    What is decoded isn't read again (``&amp;lt;`` gives ``&lt;``); null stays null.
    """
    names = F.from_json(F.lit(json.dumps(NAMED)), "map<string,string>")  # one constant, not thousands of expressions

    def sign(piece: Column) -> Column:
        name = F.substring_index(F.substring(piece, 2, 40), ";", 1)
        digits = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 40), 16, 10)).otherwise(F.substring(name, 2, 40)).try_cast("int")
        sound = digits.between(1, 0xD7FF) | digits.between(0xE000, 0x10FFFF)
        byte = F.when(sound, F.decode(F.unhex(F.lpad(F.hex(digits), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))
        numbered = F.when(name.startswith("#"), byte)
        return F.when(piece.rlike("^&.+;$"), F.coalesce(F.try_element_at(names, name), numbered, piece)).otherwise(piece)

    pieces = F.regexp_extract_all(c, F.lit(r"(?s)&(?:[A-Za-z][A-Za-z0-9]*|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});|[^&]+|&"), F.lit(0))
    return F.when(~c.contains("&"), c).otherwise(F.array_join(F.transform(pieces, sign), ""))


def _bullet(c: Column, keep: bool) -> Column:
    first = F.lit(None).cast("string")
    for p in reversed(BULLETS):
        pattern = rf"^{SPACE}*({p}){SPACE}*"
        first = F.when(c.rlike(pattern), F.regexp_replace(c, pattern, "$1 " if keep else "")).otherwise(first if p != BULLETS[-1] else c)
    return first


def clean_clinical_text(c: Column) -> Column:
    """Tags to blanks or nothing, entities decoded, white space collapsed, a leading list mark set off.

    Null and blank give ''.
    """
    t = F.regexp_replace(F.coalesce(c, F.lit("")), BLOCK_TAGS, " ")
    t = collapse(decode_entities(F.regexp_replace(t, ANY_TAG, "")))
    return F.trim(_bullet(t, keep=True))


def plain_text(c: Column) -> Column:
    """Tags to blanks, entities decoded, list marks at line starts removed, collapsed; null gives ''."""
    t = decode_entities(F.regexp_replace(F.coalesce(c, F.lit("")), ANY_TAG, " "))
    for p in BULLETS:
        t = F.regexp_replace(t, rf"(?m)^[ \t]*{p}[ \t]*", "")
    return collapse(t)


def has_meaningful_content(c: Column) -> Column:
    """At least 10 characters and three words of three letters or more; false for null."""
    t = plain_text(c)
    words = F.filter(F.split(t, " "), lambda w: w.rlike(r"^\p{L}{3,}$"))
    return (F.length(t) >= 10) & (F.size(words) >= 3)


def section_text(c: Column) -> Column:
    """White space collapsed; blank gives null."""
    return F.nullif(collapse(c), F.lit(""))


def trigrams(c: Column) -> Column:
    """Distinct three-letter runs of the lower-case text, two blanks before and one after."""
    t = F.concat(F.lit("  "), F.lower(c), F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(t) - 2), lambda i: F.substring(t, i, F.lit(3))))


def trigram_similarity(a: Column, b: Column) -> Column:
    """Common trigrams by all."""
    common = F.size(F.array_intersect(trigrams(a), trigrams(b)))
    return common / (F.size(trigrams(a)) + F.size(trigrams(b)) - common)
