"""Section routing and clinical text: rewriting by section type, dosages, warnings, keywords, reading ease."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelmill.functions.text import unescape

# LOINC code -> (section type, strategy).
SECTIONS = {
    "48780-1": ("SPL_LISTING", "PRODUCT_LISTING"),
    "55106-9": ("ACTIVE_INGREDIENT", "INGREDIENT_FOCUS"),
    "55105-1": ("PURPOSE", "INGREDIENT_FOCUS"),
    "34071-1": ("WARNINGS", "CLINICAL_TEXT"),
    "50570-1": ("DO_NOT_USE", "CLINICAL_TEXT"),
    "50569-3": ("ASK_DOCTOR", "CLINICAL_TEXT"),
    "50567-7": ("WHEN_USING", "CLINICAL_TEXT"),
    "50566-9": ("STOP_USE", "CLINICAL_TEXT"),
    "53414-9": ("PREGNANCY_BREASTFEEDING", "CLINICAL_TEXT"),
    "50565-1": ("KEEP_OUT_OF_REACH", "CLINICAL_TEXT"),
    "34067-9": ("INDICATIONS_USAGE", "CLINICAL_TEXT"),
    "51727-6": ("INACTIVE_INGREDIENT", "INGREDIENT_FOCUS"),
    "42229-5": ("UNCLASSIFIED", "CLINICAL_TEXT"),
}
# Section types every label should have, by document type.
EXPECTED = {
    "OTC": ["ACTIVE_INGREDIENT", "PURPOSE", "WARNINGS", "DO_NOT_USE", "INDICATIONS_USAGE", "INACTIVE_INGREDIENT"],
    "OTHER": ["INDICATIONS_USAGE", "WARNINGS", "SPL_LISTING"],
}
# Abbreviations and what they stand for.
ABBREVIATIONS = {
    "tid": "three times daily", "bid": "twice daily", "qd": "once daily", "prn": "as needed", "po": "by mouth", "iv": "intravenous",
    "im": "intramuscular", "sc": "subcutaneous", "sq": "subcutaneous",
}
# Rewriting rules of a section type, in order: (pattern, replacement).
WARNINGS = [
    (r"(?i)\bWARNING\b", "WARNING"),
    (r"(?i)\bDANGER\b", "DANGER"),
    (r"(?i)\bCAUTION\b", "CAUTION"),
    (r"(?i)\bBLACK BOX\b", "BLACK BOX"),
    (r"(?i)\bCONTRAINDICATED\b", "CONTRAINDICATED"),
    (r"(?i)\bSERIOUS\b", "SERIOUS"),
    (r"(?i)\bSEVERE\b", "SEVERE"),
    (r"(?m)^\s*(\d+)\.", "•"),
]
INDICATIONS = [
    (r"(?i)\bfor the treatment of\b", "treats"),
    (r"(?i)\bis indicated for\b", "is used to treat"),
    (r"(?i)\bis used in the treatment of\b", "treats"),
    (r"(?i)\bmanagement of\b", "treatment of"),
    (r"(?i)(\d+)\s*(tablet|capsule|dose)", r"$1 $2"),
    (r"(?i)(\d+)\s*(time|times)\s*(per|a)\s*(day|week)", r"$1 $2 per $4"),
]
INGREDIENTS = [
    (r"([A-Z][A-Za-z\s]+)(\d+\.?\d*\s*(?:mg|g|mcg|%|units?))", r"$1 $2"),
    (r"(?i)\bmg\.\b", "mg"),
    (r"(?i)\bg\.\b", "g"),
    (r"(?i)\bmcg\.\b", "mcg"),
    (r"(?i)\bIU\.\b", "IU"),
    (r"(?i)\bunits?\.\b", "units"),
]
DO_NOT_USE = [
    (r"(?i)\bDo not use\b", "DO NOT USE"),
    (r"(?i)\bNever use\b", "NEVER USE"),
    (r"(?i)\bAvoid\b", "AVOID"),
    (r"(?i)\bContraindicated\b", "CONTRAINDICATED"),
    (r"(?i)\bif you\b", "\nif you"),
]
REWRITES = {
    "WARNINGS": WARNINGS,
    "INDICATIONS_USAGE": INDICATIONS,
    "ACTIVE_INGREDIENT": INGREDIENTS,
    "INACTIVE_INGREDIENT": INGREDIENTS,
    "DO_NOT_USE": DO_NOT_USE,
    "ASK_DOCTOR": [(r"(?i)\bif you have\b", "\n• if you have")],
    "WHEN_USING": [(r"(?i)\bdo not\b", "\n• do not")],
    "STOP_USE": [(r"(?i)\bstop use\b", "STOP USE")],
}
# Dosage patterns, each giving rows of its own.
DOSAGES = [
    r"(?i)(\d+(?:\.\d+)?)\s*(tablet|capsule|dose)s?\s*(?:(\d+)\s*times?\s*(?:per|a)\s*(day|week|month))?",
    r"(?i)(\d+(?:\.\d+)?)\s*(mg|g|mcg|mL)\s*(?:(\d+)\s*times?\s*(?:per|a)\s*(day|week|month))?",
    r"(?i)(?:take|use)\s*(\d+(?:\.\d+)?)\s*(tablet|capsule|dose)s?\s*(?:(\d+)\s*times?\s*(?:per|a)\s*(day|week|month))?",
]
# Contraindication spans.
CONTRAINDICATIONS = [r"(?is)do not use[^.]*if[^.]*", r"(?is)contraindicated[^.]*in[^.]*", r"(?is)should not be used[^.]*", r"(?is)avoid[^.]*if[^.]*"]
# Keyword groups.
KEYWORDS = [
    "tablet|capsule|dose|dosage|mg|g|mcg|ml", "daily|twice|once|morning|evening|bedtime", "treat|treatment|prevent|relief|symptom",
    "side effect|adverse|reaction|allergy", "doctor|physician|pharmacist|healthcare",
]


def section_type(loinc: Column) -> Column:
    entries = F.create_map(*[F.lit(x) for k, (t, _) in SECTIONS.items() for x in (k, t)])
    return F.try_element_at(entries, loinc)


def strategy(loinc: Column) -> Column:
    entries = F.create_map(*[F.lit(x) for k, (_, s) in SECTIONS.items() for x in (k, s)])
    return F.coalesce(F.try_element_at(entries, loinc), F.lit("GENERIC"))


def expand_abbreviations(c: Column) -> Column:
    for short, long in ABBREVIATIONS.items():
        c = F.regexp_replace(c, rf"(?i)\b{short}\b", long)
    return c


# Cleaning of any section, in order.
CLEANING = [
    (r"[ \t]+", " "),
    (r"\n[ \t]*\n", "\n\n"),
    (r"•\s*", "• "),
    (r"(?m)^\s*•\s*", "• "),
]


def clean_section(c: Column) -> Column:
    """Entities of the whole table, blanks, blank lines and bullets made regular, abbreviations written out.

    Paragraphs stay apart; other list marks than the bullet stay as they are.
    """
    t = unescape(c)
    for pattern, replacement in CLEANING:
        t = F.regexp_replace(t, pattern, replacement)
    return F.regexp_replace(expand_abbreviations(t), r"^\s+|\s+$", "")


def clinical_text(c: Column, kind: Column) -> Column:
    """The text rewritten by its section type, then cleaned."""
    out = F.when(F.lit(False), c)
    for name, rules in REWRITES.items():
        t = c
        for pattern, replacement in rules:
            t = F.regexp_replace(t, pattern, replacement)
        out = out.when(kind == name, t)
    return clean_section(out.otherwise(c))


def dosages(c: Column) -> Column:
    """Array of struct(amount, unit, frequency, frequency_unit, full_match), pattern by pattern; empty for null."""
    found = []
    for p in DOSAGES:
        group = lambda k, p=p: F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(p), F.lit(k))
        zipped = F.arrays_zip(*[group(k).alias(n) for k, n in ((1, "amount"), (2, "unit"), (3, "frequency"), (4, "frequency_unit"), (0, "full_match"))])
        found.append(
            F.transform(
                zipped,
                lambda r: F.struct(
                    r["amount"].alias("amount"), r["unit"].alias("unit"), F.nullif(r["frequency"], F.lit("")).alias("frequency"),
                    F.nullif(r["frequency_unit"], F.lit("")).alias("frequency_unit"), r["full_match"].alias("full_match"),
                ),
            )
        )
    return F.concat(*found)


def warning_items(c: Column) -> Column:
    """Items of a list of warnings, those of more than ten characters; empty for null."""
    items = F.split(F.coalesce(c, F.lit("")), r"(?:\n|^)\s*(?:•|\d+\.|\*)\s*")
    return F.filter(F.transform(items, lambda x: F.trim(F.regexp_replace(x, r"^\s+|\s+$", ""))), lambda x: F.length(x) > 10)


def contraindications(c: Column) -> Column:
    t = F.coalesce(c, F.lit(""))
    return F.concat(*[F.transform(F.regexp_extract_all(t, F.lit(p), F.lit(0)), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")) for p in CONTRAINDICATIONS])


def keywords(c: Column) -> Column:
    """Distinct keywords of the lower-case text, sorted; empty for null."""
    t = F.lower(F.coalesce(c, F.lit("")))
    return F.array_sort(F.array_distinct(F.concat(*[F.regexp_extract_all(t, F.lit(rf"\b({k})\b"), F.lit(1)) for k in KEYWORDS])))


def text_words(c: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def syllables(w: Column) -> Column:
    """Vowel groups, less a silent final e, at least one."""
    t = F.lower(w)
    groups = F.size(F.regexp_extract_all(t, F.lit("[aeiouy]+"), F.lit(0)))
    return F.greatest(F.lit(1), groups - F.when(t.endswith("e") & (groups > 1), 1).otherwise(0))


def reading_ease(c: Column) -> Column:
    """struct(n_sentences, n_words, n_syllables, grade, sentence_length, word_length); zeros for an empty text."""
    sentences = F.size(F.filter(F.split(F.coalesce(c, F.lit("")), "[.!?]+"), lambda s: F.trim(s) != ""))
    w = text_words(c)
    n = F.size(w)
    syl = F.aggregate(w, F.lit(0), lambda a, x: a + syllables(x))
    letters = F.aggregate(w, F.lit(0), lambda a, x: a + F.length(x))
    some = (n > 0) & (sentences > 0)
    grade = F.greatest(F.lit(0.0), 0.39 * n / sentences + 11.8 * syl / n - 15.59)
    zero = F.lit(0.0)
    return F.struct(
        sentences.alias("n_sentences"), n.alias("n_words"), syl.alias("n_syllables"), F.when(some, grade).otherwise(zero).alias("grade"),
        F.when(some, n / sentences).otherwise(zero).alias("sentence_length"), F.when(some, letters / n).otherwise(zero).alias("word_length"),
    )


def completeness(id: Column, code: Column, text: Column) -> Column:
    """Share of six features a section has; three can be told from the tables."""
    has = lambda c: F.when(c, 1).otherwise(0)
    return (has(F.coalesce(id, F.lit("")) != "") + has(F.coalesce(code, F.lit("")) != "") + has(F.coalesce(F.length(F.trim(text)), F.lit(0)) > 10)) / F.lit(6.0)
