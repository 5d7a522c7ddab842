"""Queries of the column functions over the label tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.functions import clinical, dates, indication, ingredient, ndc, text, units
from labelmill.plans.views import A, I, M, N, S, distinct_list
from labelmill.sources.tables import children, medications

AS_OF = "2024-01-01"


def _texts(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return children(spark, sf_dir, "spl_sections", ["section_text", *more])


def html_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("id", text.clean_clinical_text(F.col("section_text")).alias("cleaned"))


def html_plain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("indication_text")
    rows = children(spark, sf_dir, "indications", ["indication_text"])
    return rows.select("id", text.plain_text(t).alias("plain"), text.has_meaningful_content(t).alias("meaningful"))


def entities_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full HTML table; checked in tests against Python's html module."""
    return _texts(spark, sf_dir).select("id", text.decode_all_entities(F.col("section_text")).alias("decoded"))


def section_text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("id", text.section_text(F.col("section_text")).alias("cleaned"))


def reading_ease(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _texts(spark, sf_dir).select("id", clinical.reading_ease(F.col("section_text")).alias("r"))
    rounded = [F.round(f"r.{c}", 6).alias(c) for c in ("grade", "sentence_length", "word_length")]
    return r.select("id", "r.n_sentences", "r.n_words", "r.n_syllables", *rounded)


def section_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("id", clinical.keywords(F.col("section_text")).alias("keywords"))


def dosage_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("id", F.inline(clinical.dosages(F.col("section_text"))))


def warnings_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _texts(spark, sf_dir, "loinc_code").where("loinc_code = '34071-1'")
    return rows.select("id", F.posexplode(clinical.warning_items(F.col("section_text"))).alias("pos", "item"))


def contraindications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("id", F.explode(clinical.contraindications(F.col("section_text"))).alias("span"))


def section_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("loinc_code")
    rows = children(spark, sf_dir, "spl_sections", ["loinc_code"])
    return rows.select("id", "loinc_code", clinical.section_type(c).alias("section_type"), clinical.strategy(c).alias("strategy"))


def clinical_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section texts rewritten by section type; rule by rule checked in tests."""
    rows = _texts(spark, sf_dir, "loinc_code").where("section_text is not null")
    kind = clinical.section_type(F.col("loinc_code"))
    return rows.select("id", kind.alias("section_type"), clinical.clinical_text(F.col("section_text"), kind).alias("text"))


def section_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _texts(spark, sf_dir, "loinc_code", "parent_section_id")
    filled = F.length(F.trim("section_text")) > 0
    return rows.groupBy(F.coalesce("loinc_code", F.lit("UNKNOWN")).alias("code")).agg(
        F.count("*").alias("n_sections"), F.count_if(filled).alias("n_with_text"), F.count_if(F.col("parent_section_id").isNotNull()).alias("n_subsections")
    )


def first_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per label and section type the first text, by order and id."""
    rows = _texts(spark, sf_dir, "spl_id", "loinc_code", "section_order").where("section_text is not null")
    rows = rows.withColumn("section_type", clinical.section_type(F.col("loinc_code"))).where("section_type is not null")
    place = F.struct(F.coalesce("section_order", F.lit(2**31 - 1)).alias("o"), "id", "section_text")
    first = rows.groupBy("spl_id", "section_type").agg(F.min(place).alias("f"), F.count("*").alias("n"))
    return first.select("spl_id", "section_type", F.col("f.id").alias("first_id"), F.col("f.section_text").alias("first_text"), "n")


def section_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _texts(spark, sf_dir, "section_id", "loinc_code")
    n = F.length("section_text")
    share = clinical.completeness(F.col("section_id"), F.col("loinc_code"), F.col("section_text"))
    return rows.agg(
        F.count("*").alias("n_sections"), F.round(F.avg(n), 6).alias("avg_length"), F.max(n).alias("max_length"), F.min(n).alias("min_length"),
        F.round(F.avg(share), 6).alias("avg_completeness"),
    )


def missing_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected section types a label lacks; over-the-counter labels need more."""
    meds = medications(spark, sf_dir, ["document_code"])
    there = children(spark, sf_dir, "spl_sections", ["spl_id", "loinc_code"]).groupBy("spl_id").agg(
        F.collect_set(clinical.section_type(F.col("loinc_code"))).alias("there")
    )
    lists = {k: F.array(*[F.lit(x) for x in v]) for k, v in clinical.EXPECTED.items()}
    expected = F.when(F.col("document_code") == "34390-5", lists["OTC"]).otherwise(lists["OTHER"])
    lacking = F.array_sort(F.array_except(expected, F.coalesce("there", F.array().cast("array<string>"))))
    return meds.join(there, "spl_id", "left").select("spl_id", lacking.alias("missing"))


def date_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Effective dates written in five ways by the label's version, read back."""
    d = F.col("effective_date")
    written = (
        F.when(F.col("version_number") % 5 == 0, F.date_format(d, "yyyyMMdd"))
        .when(F.col("version_number") % 5 == 1, F.date_format(d, "MM/dd/yyyy"))
        .when(F.col("version_number") % 5 == 2, F.date_format(d, "MMMM d, yyyy"))
        .when(F.col("version_number") % 5 == 3, F.concat(F.lit("Revised "), F.date_format(d, "yyyy-MM-dd"), F.lit(" in full")))
        .otherwise(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"))
    )
    rows = medications(spark, sf_dir, ["version_number", "effective_date"])
    return rows.select("spl_id", dates.normalize_date(written).alias("iso"))


def date_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = F.lit(AS_OF).cast("date")
    d = F.date_format("effective_date", "yyyy-MM-dd")
    rows = medications(spark, sf_dir, ["effective_date"])
    return rows.select(
        "spl_id", dates.is_iso_date(d).alias("is_date"), dates.is_future_date(d, as_of).alias("is_future"), dates.is_reasonable_drug_date(d, as_of).alias("is_reasonable")
    )


def unit_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("strength_numerator_unit")
    rows = children(spark, sf_dir, "ingredients", ["strength_numerator_unit"])
    ucum = units.normalize_unit(u)
    return rows.select("id", ucum.alias("ucum"), units.unit_category(ucum).alias("category"), units.simple_unit(u).alias("simple"), units.is_known_unit(u).alias("known"))


def quantity_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("package_description")
    rows = children(spark, sf_dir, "additional_ndc_codes", ["package_description"])
    return rows.select("id", units.quantity_value(c).alias("amount"), units.quantity_unit(c).alias("unit"))


def ucum_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = children(spark, sf_dir, "ingredients", ["strength_numerator", "strength_numerator_unit", "strength_denominator", "strength_denominator_unit"])
    cols = [F.col(f"strength_{x}") for x in ("numerator", "numerator_unit", "denominator", "denominator_unit")]
    return rows.where("strength_numerator is not null").select("id", units.ucum_expression(*cols).alias("expression"))


def ndc_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("ndc_code")
    rows = children(spark, sf_dir, "additional_ndc_codes", ["ndc_code"])
    parts = ndc.ndc_components(c)
    return rows.select(
        "id", ndc.is_valid_ndc(c).alias("valid"), ndc.normalize_ndc(c).alias("ndc"), parts["labeler"].alias("labeler"), parts["product"].alias("product"),
        parts["package"].alias("package"), ndc.hyphenated_ndc(c).alias("hyphenated"),
    )


def ndc_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes found in the labels' JSON texts."""
    rows = medications(spark, sf_dir, ["additional_data"])
    return rows.select("spl_id", F.array_sort(ndc.extract_ndcs(F.col("additional_data"))).alias("codes"))


def ndc_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per label the distinct valid codes and the invalid ones."""
    rows = children(spark, sf_dir, "additional_ndc_codes", ["spl_id", "ndc_code"]).where("ndc_code is not null")
    codes = rows.groupBy("spl_id").agg(F.array_sort(F.collect_list("ndc_code")).alias("codes"))
    return codes.select("spl_id", F.array_sort(ndc.valid_ndcs(F.col("codes"))).alias("valid"), ndc.invalid_ndcs(F.col("codes")).alias("invalid"))


def substance_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("substance_name")
    rows = children(spark, sf_dir, "ingredients", ["substance_name", "unii_code"])
    return rows.select(
        "id", ingredient.normalize_substance(n).alias("substance"), ingredient.normalize_unii(F.col("unii_code")).alias("unii"), ingredient.is_valid_substance(n).alias("valid")
    )


def ingredient_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = children(spark, sf_dir, "ingredients", ["spl_id", "ingredient_type", "substance_name", "strength_numerator", "strength_numerator_unit", "active_moiety_name"])
    return rows.groupBy("spl_id").agg(
        F.count("*").alias("n_ingredients"),
        F.count_if(F.col("ingredient_type") == "active").alias("n_active"),
        F.count_if(F.col("ingredient_type") == "inactive").alias("n_inactive"),
        distinct_list(ingredient.normalize_substance(F.col("substance_name"))).alias("substances"),
        distinct_list(units.simple_unit(F.when(F.col("strength_numerator").isNotNull(), F.col("strength_numerator_unit")))).alias("units"),
        F.coalesce(F.bool_or(F.col("strength_numerator").isNotNull()), F.lit(False)).alias("has_quantities"),
        F.coalesce(F.bool_or(F.col("active_moiety_name").isNotNull()), F.lit(False)).alias("has_moieties"),
    )


def indications_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("indication_text")
    rows = children(spark, sf_dir, "indications", ["indication_text"]).where("indication_text is not null")
    return rows.select(
        "id", indication.indication_type(t).alias("kind"), indication.condition_name(t).alias("condition"), indication.population(t).alias("population")
    )


def indications_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For labels without a section of indications the first section that speaks of use."""
    rows = children(spark, sf_dir, "spl_sections", ["spl_id", "loinc_code", "section_text", "section_order"])
    with_own = rows.where("loinc_code = '34067-9' and section_text is not null").select("spl_id").distinct()
    hits = rows.where(indication.mentions_use(F.col("section_text")) & (F.coalesce("loinc_code", F.lit("")) != "34067-9"))
    place = F.struct(F.coalesce("section_order", F.lit(2**31 - 1)).alias("o"), F.col("id"))
    first = hits.join(with_own, "spl_id", "left_anti").groupBy("spl_id").agg(F.min(place).alias("f"))
    return first.select("spl_id", F.col("f.id").alias("section"), F.lit("secondary").alias("kind"))


QUERIES = {
    f.__name__: f
    for f in (
        html_clean, html_plain_text, entities_decoded, section_text_clean, reading_ease, section_keywords, dosage_extract, warnings_list, contraindications,
        section_routing, clinical_text, section_distribution, first_texts, section_metrics, missing_sections, date_normalize, date_checks, unit_normalize, quantity_parse,
        ucum_expressions, ndc_checks, ndc_extract, ndc_dedup, substance_normalize, ingredient_summary, indications_derived, indications_fallback,
    )
}

_SP = r"[\s\x{00A0}\x{2000}-\x{200A}\x{202F}\x{3000}]"


def _entities(c: str) -> str:
    for e, s in text.ENTITIES * 2:
        quoted = s.replace("'", "''")
        c = f"replace({c}, '{e}', '{quoted}')"
    return c


def _collapse(c: str) -> str:
    return f"trim(regexp_replace({c}, '{_SP}+', ' ', 'g'))"


def _plain(c: str) -> str:
    t = _entities(f"regexp_replace(coalesce({c}, ''), '<[^>]+>', ' ', 'g')")
    for p in text.BULLETS:
        t = f"regexp_replace({t}, '(?m)^[ \\t]*{p}[ \\t]*', '', 'g')"
    return _collapse(t)


_CLEAN = _collapse(_entities(r"regexp_replace(regexp_replace(coalesce(section_text, ''), '(?i)</?(?:div|p|br|li|ul|ol)[^>]*>', ' ', 'g'), '<[^>]+>', '', 'g')"))
_BULLET = "CASE " + " ".join(f"WHEN regexp_matches(t, '^{_SP}*({p}){_SP}*') THEN regexp_replace(t, '^{_SP}*({p}){_SP}*', '\\1 ')" for p in text.BULLETS) + " ELSE t END"
_WORDS = r"regexp_extract_all(coalesce(section_text, ''), '[\p{L}\p{N}_]+')"
_SYL = "list_transform(w, lambda x: greatest(1, len(regexp_extract_all(lower(x), '[aeiouy]+')) - CASE WHEN lower(x) LIKE '%e' AND len(regexp_extract_all(lower(x), '[aeiouy]+')) > 1 THEN 1 ELSE 0 END))"
_TYPE = "CASE loinc_code " + " ".join(f"WHEN '{k}' THEN '{t}'" for k, (t, _) in clinical.SECTIONS.items()) + " END"
_STRATEGY = "CASE loinc_code " + " ".join(f"WHEN '{k}' THEN '{s}'" for k, (_, s) in clinical.SECTIONS.items()) + " ELSE 'GENERIC' END"
_DOSE = " UNION ALL ".join(
    f"""SELECT id, unnest(regexp_extract_all(t, '{p}', 1)) AS amount, unnest(regexp_extract_all(t, '{p}', 2)) AS unit,
    nullif(unnest(regexp_extract_all(t, '{p}', 3)), '') AS frequency, nullif(unnest(regexp_extract_all(t, '{p}', 4)), '') AS frequency_unit,
    unnest(regexp_extract_all(t, '{p}', 0)) AS full_match FROM x"""
    for p in clinical.DOSAGES
)


def _map(table: dict[str, str], c: str, other: str = "NULL") -> str:
    return f"CASE {c} " + " ".join(f"WHEN '{s}' THEN '{u}'" for s, u in table.items()) + f" ELSE {other} END"


def _ucum(c: str) -> str:
    return f"coalesce({_map(units.UCUM, f'lower(trim({c}))')}, {_map(units.UCUM_RATIOS, f'lower(trim({c}))')})"


_CATEGORY = "CASE " + " ".join(f"WHEN ucum = '{u}' THEN '{k}'" for u, k in units.CATEGORIES.items())
_CATEGORY += " WHEN contains(ucum, '/') THEN 'ratio' WHEN ucum IN ('%', '[ppm]', '[ppb]') THEN 'concentration' WHEN ucum = 'cm2' THEN 'area' END"


def _ndc(src: str, code: str) -> str:
    """CTEs d, t, v, n that add d (digits), ok and ndc to the rows of ``src``."""
    full = r"\d{4}-\d{4}-\d{2}|\d{5}-\d{3}-\d{2}|\d{5}-\d{4}-\d|\d{6}-\d{3}-\d{2}"
    part = r"\d{4}-\d{4}|\d{5}-\d{3}|\d{5}-\d{4}|\d{6}-\d{3}"
    return rf"""d AS (SELECT *, regexp_replace(regexp_replace(trim({code}), '^(?i:NDC)[:\s]*', ''), '[-\s]', '', 'g') AS d FROM {src}),
t AS (SELECT *, CASE WHEN length(d) = 10 THEN d WHEN length(d) = 11 AND d LIKE '0%' THEN substr(d, 2, 10) END AS t,
  regexp_full_match({code}, '{part}') AS partial FROM d),
v AS (SELECT *, coalesce(partial OR CASE WHEN regexp_full_match(d, '\d{{10,11}}')
    THEN length(replace(d, d[1], '')) > 0 AND (length(d) <> 10 OR (substr(d, 1, 5) <> '00000' AND substr(d, 6, 4) <> '0000'))
    ELSE regexp_full_match({code}, '{full}') END, false) AS ok FROM t),
n AS (SELECT *, CASE WHEN ok THEN CASE WHEN partial THEN {code} WHEN t IS NOT NULL
  THEN substr(t, 1, 5) || '-' || substr(t, 6, 4) || '-' || substr(t, 10, 1) END END AS ndc FROM v)"""


def _rewritten(c: str, rules: list[tuple[str, str]]) -> str:
    """SQL of rewriting rules in order; groups are written ``\\1`` there."""
    for pattern, replacement in rules:
        quoted = re.sub(r"[$](\d)", r"\\\1", replacement).replace("'", "''")
        c = f"regexp_replace({c}, '{pattern}', '{quoted}', 'g')"
    return c


_ABBREVIATED = [(rf"(?i)\b{short}\b", long) for short, long in clinical.ABBREVIATIONS.items()]


def _clinical(c: str) -> str:
    """SQL; the entities are those of the test tables, the ampersand last."""
    by_type = " ".join(f"WHEN '{k}' THEN {_rewritten(c, rules)}" for k, rules in clinical.REWRITES.items())
    t = f"CASE {_TYPE} {by_type} ELSE {c} END"
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", "\u00a0"), ("&deg;", "°"), ("&micro;", "µ"), ("&amp;", "&")):
        t = f"replace({t}, '{entity}', '{sign}')"
    t = _rewritten(t, [*clinical.CLEANING, *_ABBREVIATED])
    return rf"regexp_replace({t}, '^\s+|\s+$', '', 'g')"


def _substance(c: str) -> str:
    t = rf"upper(trim(regexp_replace({c}, '\s+', ' ', 'g')))"
    for tail in ingredient.TAILS:
        t = f"regexp_replace({t}, '{tail}', '')"
    return f"trim({t})"


_ARRAYS = {k: "[" + ", ".join(f"'{x}'" for x in v) + "]" for k, v in clinical.EXPECTED.items()}
_CONDITION = "CASE " + " ".join(f"WHEN starts_with(lower(t), '{p}') THEN trim(substr(t, {len(p) + 1}))" for p in indication.PREFIXES) + " ELSE t END"
_POPULATION = (
    "CASE "
    + " ".join(f"WHEN regexp_matches(l, '{p}') THEN 'Age restriction found: ' || regexp_extract(l, '({p})', 1)" for p in indication.AGES)
    + " WHEN contains(l, 'children') AND contains(l, 'adult') THEN 'Children and adults' WHEN contains(l, 'children') THEN 'Children' WHEN contains(l, 'adult') THEN 'Adults' END"
)
_NUM = lambda c: rf"regexp_replace(regexp_replace(CAST(CAST({c} AS DECIMAL(24,6)) AS VARCHAR), '(\.\d*?)0+$', '\1'), '\.$', '.0')"
ORACLE = {
    "html_clean": f"SELECT id, trim({_BULLET}) AS cleaned FROM (SELECT id, {_CLEAN} AS t FROM {S})",
    "html_plain_text": rf"""WITH p AS (SELECT id, {_plain('indication_text')} AS plain FROM {N})
SELECT id, plain, length(plain) >= 10 AND len(list_filter(string_split(plain, ' '), lambda w: regexp_full_match(w, '\p{{L}}{{3,}}'))) >= 3 AS meaningful FROM p""",
    "section_text_clean": f"SELECT id, nullif({_collapse('section_text')}, '') AS cleaned FROM {S}",
    "reading_ease": f"""
WITH x AS (SELECT id, {_WORDS} AS w, len(list_filter(regexp_split_to_array(coalesce(section_text, ''), '[.!?]+'), lambda s: trim(s) <> '')) AS ns FROM {S}),
y AS (SELECT id, ns, len(w) AS n, coalesce(list_sum({_SYL}), 0) AS syl, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS letters FROM x)
SELECT id, CAST(ns AS INTEGER) AS n_sentences, CAST(n AS INTEGER) AS n_words, CAST(syl AS INTEGER) AS n_syllables,
  CASE WHEN n > 0 AND ns > 0 THEN round(greatest(0.0, 0.39 * n / ns + 11.8 * syl / n - 15.59), 6) ELSE 0.0 END AS grade,
  CASE WHEN n > 0 AND ns > 0 THEN round(n / ns, 6) ELSE 0.0 END AS sentence_length,
  CASE WHEN n > 0 AND ns > 0 THEN round(letters / n, 6) ELSE 0.0 END AS word_length FROM y""",
    "section_keywords": f"""SELECT id, list_sort(list_distinct({' || '.join(rf"regexp_extract_all(t, '\b({k})\b', 1)" for k in clinical.KEYWORDS)})) AS keywords
FROM (SELECT id, lower(coalesce(section_text, '')) AS t FROM {S})""",
    "dosage_extract": f"WITH x AS (SELECT id, coalesce(section_text, '') AS t FROM {S}) {_DOSE}",
    "warnings_list": rf"""
WITH x AS (SELECT id, list_filter(list_transform(regexp_split_to_array(coalesce(section_text, ''), '(?:\n|^)\s*(?:•|\d+\.|\*)\s*'),
  lambda x: trim(regexp_replace(x, '^\s+|\s+$', '', 'g'))), lambda x: length(x) > 10) AS l FROM {S} WHERE loinc_code = '34071-1')
SELECT id, CAST(unnest(range(0, len(l))) AS INTEGER) AS pos, unnest(l) AS item FROM x""",
    "contraindications": " UNION ALL ".join(
        rf"SELECT id, regexp_replace(unnest(regexp_extract_all(coalesce(section_text, ''), '{p}')), '^\s+|\s+$', '', 'g') AS span FROM {S}" for p in clinical.CONTRAINDICATIONS
    ),
    "section_routing": f"SELECT id, loinc_code, {_TYPE} AS section_type, {_STRATEGY} AS strategy FROM {S}",
    "clinical_text": f"SELECT id, {_TYPE} AS section_type, {_clinical('section_text')} AS text FROM {S} WHERE section_text IS NOT NULL",
    "section_distribution": f"""SELECT coalesce(loinc_code, 'UNKNOWN') AS code, count(*) AS n_sections, count(*) FILTER (length(trim(section_text)) > 0) AS n_with_text,
  count(*) FILTER (parent_section_id IS NOT NULL) AS n_subsections FROM {S} GROUP BY 1""",
    "first_texts": f"""
WITH x AS (SELECT *, {_TYPE} AS section_type, (coalesce(section_order, 2147483647), id) AS place FROM {S} WHERE section_text IS NOT NULL)
SELECT spl_id, section_type, arg_min(id, place) AS first_id, arg_min(section_text, place) AS first_text, count(*) AS n FROM x WHERE section_type IS NOT NULL GROUP BY ALL""",
    "section_metrics": f"""SELECT count(*) AS n_sections, round(avg(length(section_text)), 6) AS avg_length, CAST(max(length(section_text)) AS INTEGER) AS max_length,
  CAST(min(length(section_text)) AS INTEGER) AS min_length, round(avg((CAST(coalesce(section_id, '') <> '' AS INTEGER) + CAST(coalesce(loinc_code, '') <> '' AS INTEGER)
  + CAST(coalesce(length(trim(section_text)), 0) > 10 AS INTEGER)) / 6.0), 6) AS avg_completeness FROM {S}""",
    "missing_sections": f"""
WITH t AS (SELECT spl_id, list(DISTINCT {_TYPE}) AS l FROM {S} GROUP BY spl_id)
SELECT m.spl_id, list_sort(list_filter(CASE WHEN m.document_code = '34390-5' THEN {_ARRAYS['OTC']} ELSE {_ARRAYS['OTHER']} END,
  lambda x: t.l IS NULL OR NOT list_contains(t.l, x))) AS missing FROM {M} m LEFT JOIN t USING (spl_id)""",
    "date_normalize": f"SELECT spl_id, strftime(effective_date, '%Y-%m-%d') AS iso FROM {M}",
    "date_checks": f"""SELECT spl_id, effective_date IS NOT NULL AS is_date, coalesce(effective_date > DATE '{AS_OF}', false) AS is_future,
  coalesce(year(effective_date) BETWEEN 1950 AND 2029, false) AS is_reasonable FROM {M}""",
    "unit_normalize": f"""
WITH x AS (SELECT id, strength_numerator_unit AS u, {_ucum('strength_numerator_unit')} AS ucum FROM {I})
SELECT id, ucum, {_CATEGORY} AS category, {_map(units.SIMPLE, "lower(trim(coalesce(u, '')))", "lower(trim(coalesce(u, '')))")} AS simple,
  coalesce(u IN ({', '.join(repr(k) for k in units.KNOWN)}), false) AS known FROM x""",
    "quantity_parse": rf"""
WITH x AS (SELECT id, nullif(regexp_extract(package_description, '\b(\d*\.?\d+)\s*([a-zA-Zμ%]+(?:/[a-zA-Zμ%]+)?)\b', 1), '') AS a,
  nullif(regexp_extract(package_description, '\b(\d*\.?\d+)\s*([a-zA-Zμ%]+(?:/[a-zA-Zμ%]+)?)\b', 2), '') AS u FROM {A})
SELECT id, TRY_CAST(a AS DOUBLE) AS amount, {_ucum('u')} AS unit FROM x""",
    "ucum_expressions": f"""
WITH x AS (SELECT id, {_NUM('strength_numerator')} || ' ' || coalesce({_ucum('strength_numerator_unit')}, strength_numerator_unit, '') AS top,
  coalesce(strength_denominator, 1) AS dv, coalesce({_ucum('strength_denominator_unit')}, strength_denominator_unit, '') AS below FROM {I} WHERE strength_numerator IS NOT NULL)
SELECT id, trim(CASE WHEN dv = 1 AND below = '' THEN top WHEN dv = 1 THEN top || '/' || below ELSE top || '/' || {_NUM('dv')} || ' ' || below END) AS expression FROM x""",
    "ndc_checks": rf"""WITH {_ndc(A, 'ndc_code')}
SELECT id, ok AS valid, ndc, CASE WHEN len(string_split(ndc, '-')) = 3 THEN string_split(ndc, '-')[1] END AS labeler,
  CASE WHEN len(string_split(ndc, '-')) = 3 THEN string_split(ndc, '-')[2] END AS product, CASE WHEN len(string_split(ndc, '-')) = 3 THEN string_split(ndc, '-')[3] END AS package,
  CASE WHEN regexp_full_match(d, '\d{{10,11}}') THEN substr(d, 1, 5) || '-' || substr(d, 6, 4) || '-' || substr(d, 10, 2) END AS hyphenated FROM n""",
    "ndc_extract": rf"""
WITH e AS (SELECT spl_id, unnest(regexp_extract_all(coalesce(additional_data, ''), '(?i)\b(?:NDC[:\s]*)?(\d{{4,6}}[-\s]?\d{{3,4}}[-\s]?\d{{1,2}})\b', 1)) AS c FROM {M}),
{_ndc('e', 'c')}, g AS (SELECT spl_id, list_sort(list(DISTINCT ndc) FILTER (ndc IS NOT NULL)) AS l FROM n GROUP BY spl_id)
SELECT m.spl_id, coalesce(g.l, []) AS codes FROM {M} m LEFT JOIN g USING (spl_id)""",
    "ndc_dedup": f"""WITH r AS (SELECT spl_id, ndc_code FROM {A} WHERE ndc_code IS NOT NULL), {_ndc('r', 'ndc_code')}
SELECT spl_id, coalesce(list_sort(list(DISTINCT ndc) FILTER (ndc IS NOT NULL)), []) AS valid, coalesce(list_sort(list(DISTINCT ndc_code) FILTER (NOT ok)), []) AS invalid FROM n GROUP BY spl_id""",
    "substance_normalize": rf"""SELECT id, {_substance('substance_name')} AS substance,
  CASE WHEN regexp_full_match(upper(trim(unii_code)), '[A-Z0-9]{{10}}') THEN upper(trim(unii_code)) END AS unii,
  coalesce(length(trim(substance_name)) >= 2 AND NOT regexp_full_match(trim(substance_name), '[\d\s]+') AND NOT regexp_full_match(trim(substance_name), '[^\p{{L}}\p{{N}}]+'), false) AS valid FROM {I}""",
    "ingredient_summary": f"""
WITH x AS (SELECT *, {_substance('substance_name')} AS n, lower(trim(coalesce(CASE WHEN strength_numerator IS NOT NULL THEN strength_numerator_unit END, ''))) AS u FROM {I})
SELECT spl_id, count(*) AS n_ingredients, count(*) FILTER (ingredient_type = 'active') AS n_active, count(*) FILTER (ingredient_type = 'inactive') AS n_inactive,
  list_sort(list(DISTINCT n) FILTER (n IS NOT NULL)) AS substances, list_sort(list(DISTINCT {_map(units.SIMPLE, 'u', 'u')})) AS units,
  bool_or(strength_numerator IS NOT NULL) AS has_quantities, bool_or(active_moiety_name IS NOT NULL) AS has_moieties FROM x GROUP BY spl_id""",
    "indications_derived": f"""
WITH x AS (SELECT id, trim(indication_text) AS t, lower(indication_text) AS l FROM {N} WHERE indication_text IS NOT NULL)
SELECT id, CASE WHEN regexp_matches(l, 'prevent|prophylaxis|prophylactic') THEN 'prevention' ELSE 'primary' END AS kind,
  nullif(trim(substr({_CONDITION}, 1, 100)), '') AS condition, {_POPULATION} AS population FROM x""",
    "indications_fallback": f"""
WITH s AS (SELECT * FROM {S})
SELECT spl_id, arg_min(id, (coalesce(section_order, 2147483647), id)) AS section, 'secondary' AS kind FROM s
WHERE regexp_matches(lower(section_text), '{indication.USAGE}') AND length(trim(section_text)) > 10 AND coalesce(loinc_code, '') <> '34067-9'
  AND spl_id NOT IN (SELECT spl_id FROM s WHERE loinc_code = '34067-9' AND section_text IS NOT NULL) GROUP BY spl_id""",
}
