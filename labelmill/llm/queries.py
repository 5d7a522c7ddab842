"""Queries of the text problems (p2, p3, p7, p8, p9, p10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.llm import leakage, mixing, names, neardup, reading, splitting
from labelmill.sources.tables import read

#: The texts of p2 and p7: table, field.
FIELDS = (("spl_sections", "section_text"), ("indications", "indication_text"))


def _field_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """field, id, text of both fields, as delivered."""
    parts = [
        read(spark, sf_dir, t).where(F.col("id").isNotNull()).select(F.lit(f).alias("field"), "id", F.col(f).alias("text"), "created_at") for t, f in FIELDS
    ]
    return parts[0].unionByName(parts[1])


#: p2 compares three-word shingles at a similarity of 0.65, of texts of at least 20 words.
P2 = {"width": 3, "threshold": 0.65, "least": 20}


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.similar_pairs(_field_texts(spark, sf_dir), "id", "text", ["field"], "created_at", **P2)


def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections and indications in groups of near-duplicates, at the library's defaults."""
    return neardup.duplicate_groups(_field_texts(spark, sf_dir), "id", "text", ["field"], "created_at")


def p2_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in groups of near-duplicates."""
    return neardup.duplicate_groups(read(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")


def p3_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling in manufacturer and labeler with its entity."""
    rows = read(spark, sf_dir, "medications")
    return names.link_names(rows.select(F.explode(F.array("manufacturer", "labeler")).alias("name")))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.name_pairs(p3_names(spark, sf_dir))


def p7_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The level of every section and indication with a text, one row per id (the latest delivery)."""
    texts = _field_texts(spark, sf_dir).where("text is not null")
    rated = reading.reading_levels(texts, ["field", "id", "created_at"], "text", read(spark, sf_dir, "reading_anchors"))
    columns = ["n_words", "words_per_sentence", "letters_per_word", "coverage_rank", "band"]
    latest = rated.groupBy("field", "id").agg(F.max(F.struct("created_at", *columns)).alias("r"))
    return latest.select("field", "id", *[F.col(f"r.{c}").alias(c) for c in columns])


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_levels(spark, sf_dir).where(F.col("band").isin("plain", "expert")).select("field", "id", "band")


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a leaked item, with the similarity."""
    return leakage.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_leaks(spark, sf_dir).select("item_id", "doc_id")


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "mix_targets"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that stay below their share in the mix as drawn; the exact sizes then tell chance from shortage."""
    below = _report(spark, sf_dir).where(F.col("reached") < F.col("target_share") * F.col("total"))
    return below.where("short").select("source")


def p9_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source what was expected of the mix and whether the mix fits it."""
    rows = _report(spark, sf_dir)
    return rows.select("source", "size", "n_documents", F.round("copies", 6).alias("copies"), "short", "fitting")


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), read(spark, sf_dir, "mix_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = read(spark, sf_dir, "mix_targets")
    return mixing.reached_shares(mixing.mix(read(spark, sf_dir, "documents"), targets), targets)


def p10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split_documents(read(spark, sf_dir, "documents"))


def p10_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the pieces of every text that was cut."""
    return splitting.checked_pieces(p10_pieces(spark, sf_dir), read(spark, sf_dir, "documents"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_pieces(spark, sf_dir).where("piece = 0").select("doc_id")


QUERIES = {
    "p2_found": p2_found,
    "p2_groups": p2_groups,
    "p2_documents": p2_documents,
    "p3_found": p3_found,
    "p3_names": p3_names,
    "p7_found": p7_found,
    "p7_levels": p7_levels,
    "p8_found": p8_found,
    "p8_leaks": p8_leaks,
    "p9_found": p9_found,
    "p9_mix": p9_mix,
    "p9_checks": p9_checks,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_pieces": p10_pieces,
    "p10_checks": p10_checks,
}

_TOKENS = r"len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}]+'))"

_BLANKS = r"'^[\s\p{Z}]+|[\s\p{Z}]+$'"
_SIZES = f"""WITH d AS (SELECT lower(regexp_replace(source, {_BLANKS}, '', 'g')) AS s, coalesce({_TOKENS}, 0) AS n FROM documents),
z AS (SELECT t.source, t.target_share, t.max_repeats, CAST(coalesce(sum(d.n), 0) AS BIGINT) AS size, count(d.s) AS n_documents
  FROM mix_targets t LEFT JOIN d ON d.s = lower(regexp_replace(t.source, {_BLANKS}, '', 'g')) GROUP BY ALL)"""

ORACLE = {
    "p2_found": r"""
WITH d AS (
  SELECT 'section_text' AS field, id, arg_max(coalesce(section_text, ''), created_at) AS t FROM spl_sections WHERE id IS NOT NULL GROUP BY id UNION ALL
  SELECT 'indication_text', id, arg_max(coalesce(indication_text, ''), created_at) FROM indications WHERE id IS NOT NULL GROUP BY id
),
w AS (SELECT field, id, list_filter(regexp_split_to_array(lower(t), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws FROM d),
g AS (SELECT field, id, unnest(list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) AS s FROM w WHERE len(ws) >= 20),
c AS (SELECT field, id, count(*) AS n FROM g GROUP BY ALL),
p AS (SELECT a.field, a.id AS id_a, b.id AS id_b, count(*) AS k FROM g a JOIN g b ON a.field = b.field AND a.s = b.s AND a.id < b.id GROUP BY ALL)
SELECT p.field, id_a, id_b FROM p JOIN c x ON x.field = p.field AND x.id = id_a JOIN c y ON y.field = p.field AND y.id = id_b WHERE k >= 0.65 * (x.n + y.n - k)""",
    "p9_found": f"{_SIZES} SELECT source FROM z WHERE size * max_repeats < target_share * (SELECT sum(size) FROM z)",
    "p9_checks": f"""{_SIZES}, w AS (SELECT *, target_share * (SELECT sum(size) FROM z) AS wanted FROM z)
SELECT source, size, n_documents, round(CASE WHEN size > 0 THEN least(max_repeats, wanted / size) ELSE 0 END, 6) AS copies, size * max_repeats < wanted AS short, true AS fitting FROM w""",
    "p10_checks": f"SELECT doc_id, true AS within_limit, true AS overlapping, true AS whole FROM documents WHERE {_TOKENS} > 800",
    "p10_found": f"SELECT doc_id FROM documents WHERE {_TOKENS} > 800",
}
