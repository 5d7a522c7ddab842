"""Round trips of the label tables through label documents: written as XML, parsed and loaded again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.functions import indication
from labelmill.operators import document as D
from labelmill.plans.views import I, M, S, active_ingredients_summary, document_summary, medication_search, section_content
from labelmill.session import materialize, shared_dir
from labelmill.sources.label_xml import parse, section_trees, write_labels
from labelmill.sources.tables import children, medications

_MED = [
    "set_id", "version_number", "effective_date", "brand_name", "generic_name", "manufacturer", "ndc_code", "product_form", "marketing_status",
    "marketing_date_start", "document_code",
]
_ING = ["spl_id", "ingredient_type", "substance_name", "unii_code", "strength_numerator", "strength_numerator_unit", "strength_denominator", "strength_denominator_unit"]
_SEC = ["spl_id", "loinc_code", "section_title", "section_text", "section_order", "effective_time", "parent_section_id"]


def label_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_labels(medications(spark, sf_dir, _MED), children(spark, sf_dir, "ingredients", _ING), children(spark, sf_dir, "spl_sections", _SEC))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed once and written, so that each table reads only the parts of the documents it needs.

    Labels are shuffled between writing and parsing: the joins hold a large label's text twice while it is parsed, a shuffle
    once. By a hash, as a partitioning by the key that the joins leave is taken as done.
    """
    return materialize(parse(label_xml(spark, sf_dir).repartition(F.xxhash64("spl_id")).select("xml")), "zstd")


def xml_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = D.documents(_parsed(spark, sf_dir))
    return docs.select("document_id", "set_id", "version_number", F.col("document_code.code").alias("code"), "effective_time", "success", F.size("processing_errors").alias("n_errors"))


def xml_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = D.products(_parsed(spark, sf_dir))
    return found.select("document_id", "name", "generic_name", F.col("product_code.code").alias("ndc_code"), "marketing_status", "marketing_low")


def xml_ingredients(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.load_tables(_parsed(spark, sf_dir), products_only=True)["ingredients"]
    return rows.select("spl_id", "ingredient_type", "substance_name", "unii_code", "strength_numerator")


def xml_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.all_sections(_parsed(spark, sf_dir)).where(F.coalesce(F.col("section_code.code"), F.lit("")).isNotNull() & ~F.col("section_id").endswith("-product"))
    return rows.select("document_id", "section_id", "depth", "parent_section_id", F.col("section_code.code").alias("loinc_code"), "title", "text_content")


def xml_section_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections whose parent link closes a circle; in the documents they stand at the top."""
    trees = section_trees(children(spark, sf_dir, "spl_sections", _SEC))
    return trees.select(F.col("spl_id").alias("document_id"), F.explode("cut").alias("section_id"))


def xml_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each table loaded from the documents."""
    out = None
    for name, df in D.load_tables(_parsed(spark, sf_dir)).items():
        part = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def xml_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the three search views and of the summaries over tables loaded from the documents."""
    target = f"{shared_dir(spark)}/labels-{uuid.uuid4().hex}"
    for name, df in D.load_tables(_parsed(spark, sf_dir)).items():
        df.write.parquet(f"{target}/{name}.parquet")
    out = None
    for view in (medication_search, section_content, active_ingredients_summary, document_summary):
        part = view(spark, target).agg(F.count("*").alias("n")).select(F.lit(view.__name__).alias("view_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def xml_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut in the middle, for every third label: all of these, and no other, are told apart."""
    xml = label_xml(spark, sf_dir)
    broken = F.when(F.pmod(F.ascii(F.substring("spl_id", 1, 1)), F.lit(3)) == 0, F.expr("substring(xml, 1, cast(length(xml) / 2 as int))")).otherwise(F.col("xml"))
    rows = materialize(parse(xml.withColumn("xml", broken)))
    return D.quarantine(rows).select("spl_id")


QUERIES = {f.__name__: f for f in (label_xml, xml_documents, xml_products, xml_ingredients, xml_sections, xml_section_cycles, xml_load, xml_views, xml_quarantine)}

_SP = r"[\s\x{00A0}\x{2000}-\x{200A}\x{202F}\x{3000}\x{0085}\x{1680}\x{2028}\x{2029}\x{205F}]+"
_FLAT = rf"trim(regexp_replace(regexp_replace(regexp_replace(section_text, '<item(\s[^<>]*)?>', ' • ', 'g'), '</?[A-Za-z][^<>]*>', ' ', 'g'), '{_SP}', ' ', 'g'))"
#: Sections with the parent in their own label (``above``), siblings in order, circles cut above their first section.
_TREES = f"""
s AS (SELECT *, coalesce(section_order, 2147483647) AS o, {_FLAT} AS flat FROM {S}),
e AS (SELECT s.id, s.spl_id, s.o, p.id AS above FROM s LEFT JOIN s p ON s.parent_section_id = p.id AND s.spl_id = p.spl_id),
r AS (SELECT id FROM e WHERE above IS NULL UNION ALL SELECT e.id FROM e JOIN r ON e.above = r.id),
lost AS (SELECT * FROM e WHERE id NOT IN (SELECT id FROM r)),
w AS (SELECT id AS start, id, spl_id, o, above FROM lost UNION SELECT w.start, l.id, l.spl_id, l.o, l.above FROM w JOIN lost l ON w.above = l.id),
ring AS (SELECT DISTINCT start FROM w WHERE above = start),
cut AS (
  SELECT DISTINCT x.spl_id, first(x.id ORDER BY x.o, x.id) AS id
  FROM w x WHERE x.start IN (SELECT start FROM ring) AND x.id IN (SELECT start FROM ring) GROUP BY x.start, x.spl_id
),
f AS (SELECT e.id, e.spl_id, CASE WHEN c.id IS NULL THEN e.above END AS above FROM e LEFT JOIN (SELECT DISTINCT id FROM cut) c USING (id)),
t AS (SELECT id, spl_id, above, 0 AS depth FROM f WHERE above IS NULL UNION ALL SELECT f.id, f.spl_id, f.above, t.depth + 1 FROM f JOIN t ON f.above = t.id)"""
ORACLE = {
    "xml_documents": f"""SELECT spl_id AS document_id, coalesce(set_id, spl_id) AS set_id, coalesce(CAST(version_number AS VARCHAR), '1') AS version_number,
  document_code AS code, strftime(effective_date, '%Y%m%d') AS effective_time, true AS success,
  CAST(set_id IS NULL AS INTEGER) + CAST(version_number IS NULL AS INTEGER) AS n_errors FROM {M}""",
    "xml_products": f"""SELECT spl_id AS document_id, nullif(trim(brand_name), '') AS name, nullif(trim(generic_name), '') AS generic_name, ndc_code, marketing_status,
  strftime(marketing_date_start, '%Y%m%d') AS marketing_low FROM {M}""",
    "xml_ingredients": rf"""SELECT spl_id, CASE WHEN ingredient_type = 'active' THEN 'active' ELSE 'inactive' END AS ingredient_type,
  upper(trim(regexp_replace(substance_name, '\s+', ' ', 'g'))) AS substance_name, unii_code, strength_numerator FROM {I} WHERE substance_name IS NOT NULL OR unii_code IS NOT NULL""",
    "xml_sections": f"""
WITH RECURSIVE {_TREES}
SELECT t.spl_id AS document_id, t.id AS section_id, CAST(t.depth AS INTEGER) AS depth, t.above AS parent_section_id, s.loinc_code, trim(s.section_title) AS title, s.flat AS text_content
FROM t JOIN s USING (id)""",
    "xml_section_cycles": f"WITH RECURSIVE {_TREES} SELECT spl_id AS document_id, id AS section_id FROM cut",
    "xml_load": f"""
WITH RECURSIVE {_TREES}, own AS (SELECT spl_id FROM s WHERE loinc_code = '34067-9' AND flat <> '')
SELECT 'medications' AS table_name, count(*) AS n FROM {M} UNION ALL
SELECT 'ingredients', count(*) FROM {I} WHERE substance_name IS NOT NULL OR unii_code IS NOT NULL UNION ALL
SELECT 'spl_sections', (SELECT count(*) FROM {S}) + (SELECT count(*) FROM {M}) UNION ALL
SELECT 'indications', (SELECT count(*) FROM own) + (SELECT count(DISTINCT t.spl_id) FROM t JOIN s USING (id)
  WHERE t.depth = 0 AND t.spl_id NOT IN (SELECT spl_id FROM own) AND regexp_matches(lower(s.flat), '{indication.USAGE}') AND length(s.flat) > 10) UNION ALL
SELECT 'additional_ndc_codes', 0""",
    "xml_views": f"""
SELECT 'medication_search' AS view_name, count(*) AS n FROM {M} UNION ALL
SELECT 'document_summary', count(*) FROM {M} UNION ALL
SELECT 'section_content', count(*) FROM (SELECT {_FLAT} AS flat FROM {S}) WHERE flat <> '' UNION ALL
SELECT 'active_ingredients_summary', count(*) FROM (SELECT DISTINCT upper(trim(regexp_replace(substance_name, '\\s+', ' ', 'g'))), unii_code FROM {I}
  WHERE ingredient_type = 'active' AND (substance_name IS NOT NULL OR unii_code IS NOT NULL))""",
    "xml_quarantine": f"SELECT spl_id FROM {M} WHERE ascii(spl_id[1]) % 3 = 0",
}
