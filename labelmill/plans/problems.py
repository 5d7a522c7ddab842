"""Queries of the general data-processing problems (p1, p4, p5, p6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.operators import hierarchy as H
from labelmill.operators.history import delivered_history, periods_in_force
from labelmill.operators.nested import RECORD_LISTS, TABLES, nested_projection, nested_records, record_table
from labelmill.operators.strength import equal_but_written_differently, with_common_units
from labelmill.sources.tables import children, medications, read

STRENGTH = ["strength_numerator", "strength_numerator_unit", "strength_denominator", "strength_denominator_unit"]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = nested_records(medications(spark, sf_dir, ["additional_data"]), "spl_id", "additional_data")
    return records.select("spl_id", "node_path", "parent_path")


def _p1_table(record: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rounds = nested_projection(medications(spark, sf_dir, ["additional_data"]), "spl_id", "additional_data")
        return record_table(rounds, "spl_id", record)

    return query


def _ingredients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return children(spark, sf_dir, "ingredients", ["spl_id", "ingredient_type", "unii_code", *STRENGTH])


def p4_common_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ingredient with a strength, in common units."""
    out = with_common_units(_ingredients(spark, sf_dir).where(F.coalesce(*[F.col(c).cast("string") for c in STRENGTH]).isNotNull()))
    return out.select("id", "spl_id", "unii_code", *STRENGTH, "quantity_value", "quantity_kind")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = medications(spark, sf_dir, ["set_id"]).where("set_id is not null")
    active = _ingredients(spark, sf_dir).where((F.lower(F.trim("ingredient_type")) == "active") & F.col("unii_code").isNotNull())
    rows = with_common_units(active.join(sets, "spl_id"))
    return equal_but_written_differently(rows, ["set_id", "unii_code"], "id", STRENGTH)


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return children(spark, sf_dir, "spl_sections", ["spl_id", "parent_section_id", "section_order"])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = H.hierarchy(children(spark, sf_dir, "spl_sections", ["spl_id", "parent_section_id"]), locality="spl_id")
    return found.where("depth != 0").select("id", "root_id", "depth")


def p5_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.hierarchy_paths(_sections(spark, sf_dir), locality="spl_id")


def p5_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = H.ancestors(H.node_paths(_sections(spark, sf_dir), locality="spl_id"))
    return pairs.where("distance > 0").select(F.col("ancestor_id").alias("id"), F.col("id").alias("descendant_id"), "distance")


ATTRIBUTES = ["effective_date", "spl_id", "brand_name", "generic_name", "manufacturer", "labeler", "marketing_status"]


VERSION = ["set_id", "version_number"]


def _deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "medications").select(*VERSION, "updated_at", *ATTRIBUTES)


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered_history(_deliveries(spark, sf_dir), VERSION, ATTRIBUTES, "updated_at")


def p6_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivered state of every version; the current ones with their period in force."""
    history = _history(spark, sf_dir)
    now = periods_in_force(history.where("is_current"), "set_id", "version_number", "effective_date")
    period = now.select("set_id", "version_number", "valid_from", "valid_to", F.lit(True).alias("is_current"))
    return history.join(period, ["set_id", "version_number", "is_current"], "left")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = periods_in_force(_history(spark, sf_dir).where("is_current"), "set_id", "version_number", "effective_date")
    return now.select(
        "set_id",
        "version_number",
        F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from"),
        F.coalesce(F.date_format("valid_to", "yyyy-MM-dd"), F.lit("9999-12-31")).alias("valid_to"),
    )


QUERIES = {
    "p1_found": p1_found,
    **{f"p1_{r}": _p1_table(r) for r in RECORD_LISTS},
    "p4_found": p4_found,
    "p4_common_units": p4_common_units,
    "p5_found": p5_found,
    "p5_paths": p5_paths,
    "p5_descendants": p5_descendants,
    "p6_found": p6_found,
    "p6_history": p6_history,
}

_LATEST_SECTIONS = """
    SELECT id, arg_max(parent_section_id, created_at) AS parent FROM
    (SELECT id, created_at, coalesce(parent_section_id, '') AS parent_section_id FROM spl_sections) GROUP BY id"""

_AMONG = ", ".join(f"'{r}'" for r in RECORD_LISTS)
_HERE = "CASE WHEN r.listed AND r.pos IS NULL THEN r.path || '[0]' ELSE r.path END"
#: All nodes of the documents, from the top down.
_NODES = f"""
RECURSIVE n AS (
  SELECT spl_id, '' AS path, '' AS parent, '' AS name, false AS listed, CAST(NULL AS INTEGER) AS pos, CAST(d AS JSON) AS j
  FROM (SELECT spl_id, arg_max(coalesce(additional_data, ''), updated_at) AS d FROM medications WHERE spl_id IS NOT NULL GROUP BY spl_id) WHERE json_valid(d)
  UNION ALL
  SELECT r.spl_id,
    CASE json_type(r.j) WHEN 'OBJECT' THEN CASE WHEN {_HERE} = '' THEN e.key ELSE {_HERE} || '.' || e.key END
      WHEN 'ARRAY' THEN r.path || '[' || e.key || ']' ELSE r.path END,
    CASE WHEN json_type(r.j) = 'OBJECT' AND r.listed THEN {_HERE} ELSE r.parent END,
    CASE json_type(r.j) WHEN 'OBJECT' THEN e.key ELSE r.name END,
    CASE json_type(r.j) WHEN 'OBJECT' THEN e.key IN ({_AMONG}) WHEN 'ARRAY' THEN r.listed AND r.pos IS NULL ELSE r.listed END,
    CASE json_type(r.j) WHEN 'OBJECT' THEN NULL WHEN 'ARRAY' THEN CAST(e.key AS INTEGER) ELSE r.pos END,
    CASE WHEN json_type(r.j) = 'VARCHAR' THEN CAST(r.j ->> '$' AS JSON) ELSE e.value END
  FROM n r, LATERAL (SELECT * FROM json_each(r.j)) e
  WHERE json_type(r.j) IN ('OBJECT', 'ARRAY') OR (json_type(r.j) = 'VARCHAR' AND json_valid(r.j ->> '$') AND regexp_matches(r.j ->> '$', '^\\s*[\\[{{"]'))
),
c AS (
  SELECT spl_id, name, CASE WHEN pos IS NULL THEN path || '[0]' ELSE path END AS node_path, parent AS parent_path, coalesce(pos, 0) AS pos, j
  FROM n WHERE listed AND json_type(j) = 'OBJECT'
)"""


def _p1_sql(record: str) -> str:
    """A record's table; the test tables have no field besides the columns."""
    columns = [
        f"TRY_CAST(j ->> '$.{path}' AS DOUBLE) AS {name}" if kind == "double" else f"j ->> '$.{path}' AS \"{name}\""
        for name, (path, kind) in TABLES[record].items()
    ]
    return f"WITH {_NODES} SELECT spl_id, node_path, parent_path, pos, {', '.join(columns)}, CAST(NULL AS VARCHAR) AS more FROM c WHERE name = '{record}'"


_VALUES = ", ".join(ATTRIBUTES)

ORACLE = {
    "p1_found": f"WITH {_NODES} SELECT spl_id, node_path, parent_path FROM c",
    **{f"p1_{r}": _p1_sql(r) for r in RECORD_LISTS},
    "p5_found": f"""
WITH RECURSIVE s AS ({_LATEST_SECTIONS}),
t AS (
  SELECT id, id AS root_id, 0 AS depth FROM s WHERE parent NOT IN (SELECT id FROM s)
  UNION ALL
  SELECT s.id, t.root_id, t.depth + 1 FROM s JOIN t ON s.parent = t.id
)
SELECT id, root_id, CAST(depth AS INTEGER) AS depth FROM t WHERE depth > 0
UNION ALL
SELECT id, 'cycle' AS root_id, CAST(-1 AS INTEGER) AS depth FROM s WHERE id NOT IN (SELECT id FROM t)""",
    "p5_paths": f"""
WITH RECURSIVE s AS ({_LATEST_SECTIONS}),
o AS (SELECT id, coalesce(arg_max(coalesce(section_order, -1), created_at), -1) AS k FROM spl_sections GROUP BY id),
p AS (SELECT s.id, s.parent, CASE WHEN o.k = -1 THEN 4611686018427387904 ELSE CAST(o.k AS BIGINT) END AS place FROM s JOIN o USING (id)),
t AS (
  SELECT id, [id] AS path, [place] AS order_path, 0 AS depth, id AS root_id FROM p WHERE parent NOT IN (SELECT id FROM p)
  UNION ALL
  SELECT p.id, list_append(t.path, p.id), list_append(t.order_path, p.place), t.depth + 1, t.root_id FROM p JOIN t ON p.parent = t.id
),
b AS (SELECT a AS id, count(*) AS n FROM (SELECT unnest(path[:-2]) AS a FROM t) GROUP BY a)
SELECT t.id, path, order_path, CAST(depth AS INTEGER) AS depth, root_id, coalesce(n, 0) AS n_descendants FROM t LEFT JOIN b USING (id)""",
    "p5_descendants": f"""
WITH RECURSIVE s AS ({_LATEST_SECTIONS}),
r AS (
  SELECT id FROM s WHERE parent NOT IN (SELECT id FROM s)
  UNION ALL SELECT s.id FROM s JOIN r ON s.parent = r.id
),
t AS (
  SELECT s.parent AS id, s.id AS descendant_id, 1 AS distance FROM s JOIN r ON s.id = r.id WHERE s.parent IN (SELECT id FROM s)
  UNION ALL
  SELECT s.parent, t.descendant_id, t.distance + 1 FROM t JOIN s ON t.id = s.id WHERE s.parent IN (SELECT id FROM s)
)
SELECT id, descendant_id, CAST(distance AS INTEGER) AS distance FROM t""",
    "p6_found": """
WITH v AS (
  SELECT set_id, version_number, arg_max(coalesce(CAST(effective_date AS VARCHAR), ''), updated_at) AS d
  FROM medications WHERE set_id IS NOT NULL AND version_number IS NOT NULL GROUP BY ALL
),
w AS (
  SELECT set_id, version_number, d AS valid_from,
    min(d) OVER (PARTITION BY set_id ORDER BY version_number DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS valid_to
  FROM v WHERE d <> ''
)
SELECT set_id, version_number, valid_from, coalesce(valid_to, '9999-12-31') AS valid_to
FROM w WHERE valid_to IS NULL OR valid_from < valid_to""",
    "p6_history": f"""
WITH d AS (
  SELECT *, coalesce(updated_at, TIMESTAMPTZ '1900-01-01 00:00:00+00') AS moment FROM medications WHERE set_id IS NOT NULL AND version_number IS NOT NULL
),
o AS (
  SELECT *, row_number() OVER w AS k, lag(row({_VALUES})) OVER w AS before
  FROM d WINDOW w AS (PARTITION BY set_id, version_number ORDER BY moment, {_VALUES})
),
v AS (SELECT *, lead(k) OVER (PARTITION BY set_id, version_number ORDER BY k) IS NULL AS is_current FROM o WHERE k = 1 OR before IS DISTINCT FROM row({_VALUES})),
c AS (SELECT DISTINCT unnest(quantile_disc(moment, [0.25, 0.5, 0.75])) AS cut FROM d),
f AS (
  SELECT set_id, version_number, effective_date AS valid_from,
    min(effective_date) OVER (PARTITION BY set_id ORDER BY version_number DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS valid_to
  FROM v WHERE is_current AND effective_date IS NOT NULL
)
SELECT v.set_id, v.version_number, v.is_current, {', '.join(f'v.{a}' for a in ATTRIBUTES)}, 's' || (SELECT count(*) FROM c WHERE c.cut < v.moment) AS recorded_at,
  v.updated_at AS delivered_at, f.valid_from, f.valid_to
FROM v LEFT JOIN f ON v.is_current AND f.set_id = v.set_id AND f.version_number = v.version_number AND (f.valid_to IS NULL OR f.valid_from < f.valid_to)""",
}
