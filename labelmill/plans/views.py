"""The relational query surface: search views, lookups, summaries over the label tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelmill.functions.ndc import normalize_ndc
from labelmill.functions.text import trigram_similarity
from labelmill.sources.tables import children, medications, read

COMPLETED = "processing_status = 'completed'"
SEARCH = [
    "spl_id", "set_id", "version_number", "brand_name", "generic_name", "manufacturer", "ndc_code", "product_form", "route_of_administration",
    "approval_type", "marketing_status", "effective_date",
]
# LOINC code -> name of a section type.
SECTION_NAMES = {
    "55106-9": "Active Ingredients",
    "34071-1": "Warnings",
    "34067-9": "Indications and Usage",
    "34068-7": "Dosage and Administration",
    "50570-1": "Do Not Use",
    "50569-3": "Ask Doctor Before Use",
    "50567-7": "When Using This Product",
    "50565-1": "Keep Out of Reach of Children",
    "44425-7": "Storage and Handling",
    "51727-6": "Inactive Ingredients",
    "51945-4": "Package Label",
}
CLINICAL = [c for c in SECTION_NAMES if c != "51945-4"]


def distinct_list(value: Column, where: Column | None = None) -> Column:
    """Sorted distinct non-null values; null if there is none."""
    got = F.array_sort(F.collect_set(value if where is None else F.when(where, value)))
    return F.when(F.size(got) > 0, got)


def medication_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completed labels with their ingredients, indications and codes.

    Every child is aggregated by label before its join, so children don't multiply each other.
    """
    meds = medications(spark, sf_dir, [*SEARCH, "processing_status"]).where(COMPLETED).drop("processing_status")
    kind, name = F.col("ingredient_type"), F.col("substance_name")
    ingredients = children(spark, sf_dir, "ingredients", ["spl_id", "ingredient_type", "substance_name"]).groupBy("spl_id").agg(
        distinct_list(name, kind == "active").alias("active_ingredients"), distinct_list(name, kind == "inactive").alias("inactive_ingredients")
    )
    indications = children(spark, sf_dir, "indications", ["spl_id", "indication_text"]).groupBy("spl_id").agg(
        distinct_list(F.col("indication_text")).alias("indications")
    )
    codes = children(spark, sf_dir, "additional_ndc_codes", ["spl_id", "ndc_code"]).groupBy("spl_id").agg(
        distinct_list(F.col("ndc_code")).alias("additional_ndcs")
    )
    return meds.join(ingredients, "spl_id", "left").join(indications, "spl_id", "left").join(codes, "spl_id", "left")


def section_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    meds = medications(spark, sf_dir, ["brand_name", "generic_name", "processing_status"]).where(COMPLETED).drop("processing_status")
    kept = ["spl_id", "loinc_code", "section_title", "section_text", "section_order"]
    sections = children(spark, sf_dir, "spl_sections", kept).where("section_text is not null")
    kind = F.when(F.lit(False), F.lit(""))
    for code, name in SECTION_NAMES.items():
        kind = kind.when(F.col("loinc_code") == code, F.lit(name))
    out = sections.join(meds, "spl_id").withColumn("section_type_name", kind.otherwise(F.coalesce("section_title", F.lit("Other Section"))))
    return out.select("id", *kept, "brand_name", "generic_name", "section_type_name")


def active_ingredients_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    meds = medications(spark, sf_dir, ["brand_name", "product_form", "manufacturer", "processing_status"]).where(COMPLETED)
    active = children(spark, sf_dir, "ingredients", ["spl_id", "ingredient_type", "substance_name", "unii_code"]).where("ingredient_type = 'active'")
    out = active.join(meds, "spl_id").groupBy("substance_name", "unii_code").agg(
        F.count_distinct("spl_id").alias("medication_count"),
        distinct_list(F.col("brand_name")).alias("brand_names"),
        distinct_list(F.col("product_form")).alias("dosage_forms"),
        distinct_list(F.col("manufacturer")).alias("manufacturers"),
    )
    return out


def like_pattern(term: str) -> str:
    """A contains-pattern in which the term's own wildcards are plain signs."""
    return "%" + term.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"


def search_condition(spark: SparkSession, sf_dir: str, term: str) -> DataFrame:
    meds = medications(spark, sf_dir, ["brand_name", "generic_name"])
    rows = children(spark, sf_dir, "indications", ["spl_id", "condition_name", "indication_text"])
    pattern = like_pattern(term)
    found = rows.where(F.col("condition_name").ilike(pattern) | F.col("indication_text").ilike(pattern))
    return found.join(meds, "spl_id").select("id", "spl_id", "brand_name", "generic_name", "condition_name")


def condition_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_condition(spark, sf_dir, "pain")


def sections_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each label's sections in order, numbered from 1; the rank is taken on keys only."""
    rows = children(spark, sf_dir, "spl_sections", ["spl_id", "loinc_code", "section_order"])
    w = Window.partitionBy("spl_id").orderBy(F.col("section_order").asc_nulls_last(), "id")
    return rows.withColumn("position", F.row_number().over(w))


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return children(spark, sf_dir, "spl_sections", ["spl_id", "loinc_code", "section_title", "section_text"])


def sections_by_loinc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sections(spark, sf_dir).where(F.col("loinc_code").isin("34067-9", "34071-1"))


def clinical_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sections(spark, sf_dir).where(F.col("loinc_code").isin(*CLINICAL))


def text_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sections(spark, sf_dir).where(F.length(F.trim("section_text")) > 0)


def active_ingredients(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = children(spark, sf_dir, "ingredients", ["spl_id", "ingredient_type", "substance_name", "unii_code"])
    return rows.where("ingredient_type = 'active'").drop("ingredient_type")


def indications_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = children(spark, sf_dir, "indications", ["spl_id", "indication_type", "condition_name"])
    return rows


def document_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per label the number of its child rows of each table."""
    out = medications(spark, sf_dir, ["set_id", "version_number"])
    for table, name in (("ingredients", "n_ingredients"), ("spl_sections", "n_sections"), ("indications", "n_indications"), ("additional_ndc_codes", "n_codes")):
        counts = children(spark, sf_dir, table, ["spl_id"]).groupBy("spl_id").agg(F.count("*").alias(name))
        out = out.join(counts, "spl_id", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child rows whose label doesn't exist, by table."""
    labels = medications(spark, sf_dir, []).select("spl_id")
    out = None
    for table in ("ingredients", "spl_sections", "indications", "additional_ndc_codes"):
        part = read(spark, sf_dir, table).join(labels, "spl_id", "left_anti").agg(F.count("*").alias("n")).select(F.lit(table).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = read(spark, sf_dir, "medications").agg(F.count("*").alias("n")).select(F.lit("medications").alias("table_name"), "n")
    for table in ("ingredients", "spl_sections", "indications", "additional_ndc_codes"):
        out = out.unionByName(read(spark, sf_dir, table).agg(F.count("*").alias("n")).select(F.lit(table).alias("table_name"), "n"))
    return out


def newest_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five labels processed last that have a brand (a top-k report)."""
    rows = medications(spark, sf_dir, ["brand_name", "processed_at"]).where("brand_name is not null and processed_at is not null")
    return rows.orderBy(F.desc("processed_at"), "spl_id").limit(5)


def ndc_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every code, primary or additional, in normal form with its labels."""
    primary = medications(spark, sf_dir, ["ndc_code"]).select("spl_id", "ndc_code", F.lit("primary").alias("origin"))
    more = children(spark, sf_dir, "additional_ndc_codes", ["spl_id", "ndc_code"]).select("spl_id", "ndc_code", F.lit("additional").alias("origin"))
    rows = primary.unionByName(more).withColumn("ndc", normalize_ndc(F.col("ndc_code"))).where("ndc is not null")
    return rows.groupBy("ndc").agg(distinct_list(F.col("spl_id")).alias("spl_ids"), F.max("origin").alias("origin"))


def label_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per label family its newest version with all brands, forms and companies it ever had."""
    rows = medications(spark, sf_dir, ["set_id", "version_number", "brand_name", "product_form", "manufacturer"]).where("set_id is not null")
    return rows.groupBy("set_id").agg(
        F.max("version_number").alias("version_number"),
        F.count("*").alias("n_versions"),
        distinct_list(F.col("brand_name")).alias("brand_names"),
        distinct_list(F.col("product_form")).alias("product_forms"),
        distinct_list(F.col("manufacturer")).alias("manufacturers"),
    )


def trigram_similarities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per label how alike manufacturer and labeler are spelt."""
    rows = medications(spark, sf_dir, ["manufacturer", "labeler"]).where("manufacturer is not null and labeler is not null")
    return rows.select("spl_id", F.round(trigram_similarity(F.col("manufacturer"), F.col("labeler")), 6).alias("similarity"))


def get_records(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """One record per key of ``keys`` that exists, all columns; of several rows of a key the largest by its other columns. Null keys match nothing."""
    rest = [c for c in df.columns if c not in on]
    found = df.join(keys.select(*on).distinct(), on, "left_semi").groupBy(*on).agg(F.max(F.struct(*rest)).alias("_r"))
    return found.select(*on, *[F.col(f"_r.`{c}`").alias(c) for c in rest])


def which_exist(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The distinct keys with ``exists``: whether ``df`` has a row for them."""
    there = df.select(*on).distinct().withColumn("_there", F.lit(True))
    return keys.select(*on).distinct().join(there, on, "left").select(*on, F.col("_there").isNotNull().alias("exists"))


def label_existence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the children's labels, and of the label families' ids, are labels themselves."""
    meds = read(spark, sf_dir, "medications")
    keys = read(spark, sf_dir, "indications").select("spl_id").unionByName(meds.select(F.col("set_id").alias("spl_id"))).where("spl_id is not null")
    return which_exist(meds, keys, ["spl_id"])


def document_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per label the lookups of its children: active ingredients, indications, codes as sorted lists, and its number of sections."""
    out = medications(spark, sf_dir, ["set_id", "version_number", "brand_name"])
    parts = (
        ("ingredients", ["ingredient_type", "substance_name", "unii_code"], F.when(F.col("ingredient_type") == "active", F.struct("substance_name", "unii_code")), "active"),
        ("indications", ["indication_type", "condition_name"], F.struct("indication_type", "condition_name"), "indications"),
        ("additional_ndc_codes", ["ndc_code", "package_description"], F.struct("ndc_code", "package_description"), "codes"),
    )
    for table, columns, item, name in parts:
        rows = children(spark, sf_dir, table, ["spl_id", *columns]).groupBy("spl_id").agg(F.array_sort(F.collect_list(item)).alias(name))
        out = out.join(rows, "spl_id", "left").withColumn(name, F.to_json(F.coalesce(name, F.array()), {"ignoreNullFields": "false"}))
    counts = children(spark, sf_dir, "spl_sections", ["spl_id"]).groupBy("spl_id").agg(F.count("*").alias("n_sections"))
    return out.join(counts, "spl_id", "left").withColumn("n_sections", F.coalesce("n_sections", F.lit(0)))


QUERIES = {
    f.__name__: f
    for f in (
        medication_search, section_content, active_ingredients_summary, condition_search, sections_in_order, sections_by_loinc, clinical_sections,
        text_sections, active_ingredients, indications_in_order, document_summary, orphans, table_counts, newest_labels, ndc_lookup, label_profile,
        trigram_similarities, label_existence, document_details,
    )
}


def latest_sql(table: str) -> str:
    """DuckDB: one row per key, the latest delivery."""
    key, order = ("spl_id", "updated_at DESC, created_at DESC") if table == "medications" else ("id", "created_at DESC")
    return f"(SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1)"


M, I, S, N, A = (latest_sql(t) for t in ("medications", "ingredients", "spl_sections", "indications", "additional_ndc_codes"))


def _list(value: str, where: str = "true") -> str:
    return f"list_sort(list(DISTINCT {value}) FILTER ({where} AND {value} IS NOT NULL))"


_CASE = " ".join(f"WHEN '{c}' THEN '{n}'" for c, n in SECTION_NAMES.items())
_D = "regexp_replace(regexp_replace(trim(ndc_code), '^(?i:NDC)[:\\s]*', ''), '[-\\s]', '', 'g')"
_TRI = "list_distinct(list_transform(range(1, len({v}) - 1), lambda i: {v}[i:i+2]))"
ORACLE = {
    "medication_search": f"""
WITH i AS (SELECT spl_id, {_list('substance_name', "ingredient_type = 'active'")} AS active_ingredients,
    {_list('substance_name', "ingredient_type = 'inactive'")} AS inactive_ingredients FROM {I} GROUP BY spl_id),
n AS (SELECT spl_id, {_list('indication_text')} AS indications FROM {N} GROUP BY spl_id),
a AS (SELECT spl_id, {_list('ndc_code')} AS additional_ndcs FROM {A} GROUP BY spl_id)
SELECT {', '.join('m.' + c for c in SEARCH)}, active_ingredients, inactive_ingredients, indications, additional_ndcs
FROM {M} m LEFT JOIN i USING (spl_id) LEFT JOIN n USING (spl_id) LEFT JOIN a USING (spl_id) WHERE m.{COMPLETED}""",
    "section_content": f"""
SELECT s.id, s.spl_id, s.loinc_code, s.section_title, s.section_text, s.section_order, m.brand_name, m.generic_name,
  CASE s.loinc_code {_CASE} ELSE coalesce(s.section_title, 'Other Section') END AS section_type_name
FROM {S} s JOIN {M} m USING (spl_id) WHERE m.{COMPLETED} AND s.section_text IS NOT NULL""",
    "active_ingredients_summary": f"""
SELECT i.substance_name, i.unii_code, count(DISTINCT i.spl_id) AS medication_count, {_list('m.brand_name')} AS brand_names,
  {_list('m.product_form')} AS dosage_forms, {_list('m.manufacturer')} AS manufacturers
FROM {I} i JOIN {M} m USING (spl_id) WHERE i.ingredient_type = 'active' AND m.{COMPLETED} GROUP BY ALL""",
    "condition_search": f"""
SELECT n.id, n.spl_id, m.brand_name, m.generic_name, n.condition_name FROM {N} n JOIN {M} m USING (spl_id)
WHERE n.condition_name ILIKE '%pain%' OR n.indication_text ILIKE '%pain%'""",
    "sections_in_order": f"""
SELECT id, spl_id, loinc_code, section_order, CAST(row_number() OVER (PARTITION BY spl_id ORDER BY section_order NULLS LAST, id) AS INTEGER) AS position
FROM {S}""",
    "sections_by_loinc": f"SELECT id, spl_id, loinc_code, section_title, section_text FROM {S} WHERE loinc_code IN ('34067-9', '34071-1')",
    "clinical_sections": f"SELECT id, spl_id, loinc_code, section_title, section_text FROM {S} WHERE loinc_code IN ({', '.join(repr(c) for c in CLINICAL)})",
    "text_sections": f"SELECT id, spl_id, loinc_code, section_title, section_text FROM {S} WHERE length(trim(section_text)) > 0",
    "active_ingredients": f"SELECT id, spl_id, substance_name, unii_code FROM {I} WHERE ingredient_type = 'active'",
    "indications_in_order": f"SELECT id, spl_id, indication_type, condition_name FROM {N}",
    "document_summary": f"""
WITH i AS (SELECT spl_id, count(*) AS c FROM {I} GROUP BY ALL), s AS (SELECT spl_id, count(*) AS c FROM {S} GROUP BY ALL),
n AS (SELECT spl_id, count(*) AS c FROM {N} GROUP BY ALL), a AS (SELECT spl_id, count(*) AS c FROM {A} GROUP BY ALL)
SELECT m.spl_id, m.set_id, m.version_number, coalesce(i.c, 0) AS n_ingredients, coalesce(s.c, 0) AS n_sections,
  coalesce(n.c, 0) AS n_indications, coalesce(a.c, 0) AS n_codes
FROM {M} m LEFT JOIN i USING (spl_id) LEFT JOIN s USING (spl_id) LEFT JOIN n USING (spl_id) LEFT JOIN a USING (spl_id)""",
    "orphans": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n FROM {t} WHERE spl_id NOT IN (SELECT spl_id FROM medications)"
        for t in ("ingredients", "spl_sections", "indications", "additional_ndc_codes")
    ),
    "table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in ("medications", "ingredients", "spl_sections", "indications", "additional_ndc_codes")
    ),
    "newest_labels": f"""
SELECT spl_id, brand_name, processed_at FROM {M} WHERE brand_name IS NOT NULL AND processed_at IS NOT NULL ORDER BY processed_at DESC, spl_id LIMIT 5""",
    "ndc_lookup": f"""
WITH r AS (SELECT spl_id, ndc_code, 'primary' AS origin FROM {M} UNION ALL SELECT spl_id, ndc_code, 'additional' FROM {A}),
d AS (SELECT *, {_D} AS d FROM r),
t AS (SELECT *, CASE WHEN length(d) = 10 THEN d WHEN length(d) = 11 AND d LIKE '0%' THEN substr(d, 2, 10) END AS t,
  regexp_full_match(ndc_code, '\\d{{4}}-\\d{{4}}|\\d{{5}}-\\d{{3}}|\\d{{5}}-\\d{{4}}|\\d{{6}}-\\d{{3}}') AS partial FROM d),
v AS (SELECT *, partial OR CASE WHEN regexp_full_match(d, '\\d{{10,11}}')
    THEN length(replace(d, d[1], '')) > 0 AND (length(d) <> 10 OR (substr(d, 1, 5) <> '00000' AND substr(d, 6, 4) <> '0000'))
    ELSE regexp_full_match(ndc_code, '\\d{{4}}-\\d{{4}}-\\d{{2}}|\\d{{5}}-\\d{{3}}-\\d{{2}}|\\d{{5}}-\\d{{4}}-\\d|\\d{{6}}-\\d{{3}}-\\d{{2}}') END AS ok FROM t),
n AS (SELECT *, CASE WHEN ok THEN CASE WHEN partial THEN ndc_code WHEN t IS NOT NULL THEN substr(t, 1, 5) || '-' || substr(t, 6, 4) || '-' || substr(t, 10, 1) END END AS ndc FROM v)
SELECT ndc, {_list('spl_id')} AS spl_ids, max(origin) AS origin FROM n WHERE ndc IS NOT NULL GROUP BY ndc""",
    "label_profile": f"""
SELECT set_id, max(version_number) AS version_number, count(*) AS n_versions, {_list('brand_name')} AS brand_names,
  {_list('product_form')} AS product_forms, {_list('manufacturer')} AS manufacturers FROM {M} WHERE set_id IS NOT NULL GROUP BY set_id""",
    "trigram_similarities": f"""
WITH t AS (SELECT spl_id, '  ' || lower(manufacturer) || ' ' AS a, '  ' || lower(labeler) || ' ' AS b FROM {M} WHERE manufacturer IS NOT NULL AND labeler IS NOT NULL),
s AS (SELECT spl_id, {_TRI.format(v='a')} AS x, {_TRI.format(v='b')} AS y FROM t)
SELECT spl_id, round(len(list_intersect(x, y)) / (len(x) + len(y) - len(list_intersect(x, y))), 6) AS similarity FROM s""",
    "label_existence": """
SELECT spl_id, spl_id IN (SELECT spl_id FROM medications) AS exists FROM
(SELECT spl_id FROM indications UNION SELECT set_id FROM medications) WHERE spl_id IS NOT NULL""",
}
