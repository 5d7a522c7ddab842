"""Queries of validation, versions, catalogue and run figures, and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.operators import metrics, upsert, validation
from labelmill.plans.views import I, M, S
from labelmill.sources.discover import release_links
from labelmill.sources.tables import children, medications, read
from labelmill.streaming.ingest import event_windows, streamed_labels, streamed_windows


def validation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    meds = medications(spark, sf_dir, ["set_id", "document_code", "effective_date", "version_number"])
    secs = children(spark, sf_dir, "spl_sections", ["spl_id", "section_id", "loinc_code", "parent_section_id"])
    drugs = children(spark, sf_dir, "ingredients", ["spl_id", "ingredient_type", "substance_name", "strength_numerator", "strength_numerator_unit", "strength_denominator"])
    out = validation.label_messages(meds).unionByName(validation.section_messages(secs)).unionByName(validation.ingredient_messages(drugs))
    return out.unionByName(validation.structure_messages(meds, secs, drugs))


def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.summary(validation_messages(spark, sf_dir), medications(spark, sf_dir, []))


def latest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of deliveries upserted by (set_id, version_number): the last half onto the first."""
    keep = ["set_id", "version_number", "spl_id", "brand_name", "marketing_status", "updated_at"]
    rows = read(spark, sf_dir, "medications").select(*keep)
    return upsert.upsert(rows.where("updated_at < '2016-01-01'"), rows.where("updated_at >= '2016-01-01'"), ["set_id", "version_number"], "updated_at").select(*keep)


def version_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a download log: a user is a file, its events are its versions."""
    rows = read(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return upsert.numbered_versions(rows, "user_id", ["ts", "event_id"])


def changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return upsert.changes(rows, "user_id", ["ts", "event_id"], ["event_type"]).where("is_changed").select("event_id", "user_id", "event_type")


def first_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    return upsert.dedup_first(rows, ["user_id", "event_type"], ["ts", "event_id"])


def key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.key_collisions(read(spark, sf_dir, "medications"), "spl_id", ["set_id", "version_number"])


def catalog_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.catalog_stats(read(spark, sf_dir, "documents"), "n_chars", "ingested_at")


def batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select((F.col("event_type") != "error").alias("ok"), F.round("value", 4).alias("seconds"))
    return metrics.batch_stats(rows, "ok", "seconds")


def top_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five most frequent kinds of processing errors (a top-k report)."""
    return metrics.top_errors(medications(spark, sf_dir, ["processing_errors"]), "processing_errors")


def quality_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = ["brand_name is not null", "effective_date is not null", "ndc_code is not null", "document_code is not null", "manufacturer is not null"]
    rows = medications(spark, sf_dir, ["brand_name", "effective_date", "ndc_code", "document_code", "manufacturer"])
    out = metrics.quality_bands(rows, checks).groupBy("quality_band").agg(F.count("*").alias("n"), F.round(F.avg("quality_score"), 6).alias("avg_score"))
    return out


def links_discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Release pages written from the labels (a page per document type, a link per label and once more), read back."""
    rows = medications(spark, sf_dir, ["document_code"]).where("document_code is not null")
    name = F.concat(F.lit("dm_spl_release_human_rx_"), "spl_id", F.lit(".zip"))
    link = F.concat(F.lit('<a href="/files/'), name, F.lit('">x</a><a href="'), name, F.lit('">again</a>'))
    pages = rows.groupBy("document_code", F.substring("spl_id", 1, 2).alias("part")).agg(F.array_join(F.array_sort(F.collect_list(link)), "").alias("links"))
    url = F.concat(F.lit("https://example.org/"), "document_code", F.lit("/"), "part", F.lit("/index.html"))
    pages = pages.select(url.alias("url"), F.concat(F.lit("<h3>Full Releases</h3>"), "links").alias("html"))
    return release_links(pages).select("url", "filename")


def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_windows(read(spark, sf_dir, "events"))


QUERIES = {
    f.__name__: f
    for f in (
        validation_messages, validation_summary, latest_versions, version_history, changed_files, first_events, key_collisions, catalog_stats, batch_stats,
        top_errors, quality_bands, links_discover, hourly_events, streamed_windows, streamed_labels,
    )
}

_UUID = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"


def _rule(context: str, table: str, when: str, severity: str, field: str, message: str) -> str:
    return f"SELECT spl_id, '{context}' AS context, '{severity}' AS severity, '{field}' AS field, '{message}' AS message FROM {table} WHERE {when}"


def _blank(c: str) -> str:
    return f"coalesce(trim({c}), '') = ''"


_KNOWN = ", ".join(f"'{k}'" for k in validation.clinical.SECTIONS)
_CODES = {t: next(k for k, (x, _) in validation.clinical.SECTIONS.items() if x == t) for t in validation.REQUIRED_TYPES}
_MESSAGES = " UNION ALL ".join(
    [
        _rule("label", M, _blank("spl_id"), "error", "spl_id", "is required"),
        _rule("label", M, f"NOT coalesce(regexp_full_match(spl_id, '{_UUID}'), true)", "error", "spl_id", "is not a UUID"),
        _rule("label", M, _blank("set_id"), "error", "set_id", "is required"),
        _rule("label", M, f"NOT coalesce(regexp_full_match(set_id, '{_UUID}'), true)", "error", "set_id", "is not a UUID"),
        _rule("label", M, _blank("document_code"), "error", "document_code", "is required"),
        _rule("label", M, "effective_date IS NULL", "warning", "effective_date", "is missing"),
        _rule("label", M, "coalesce(version_number < 1, true)", "error", "version_number", "is not positive"),
        _rule("section", S, _blank("section_id"), "error", "section_id", "is required"),
        _rule("section", S, f"NOT coalesce(regexp_full_match(section_id, '{_UUID}'), true)", "error", "section_id", "is not a UUID"),
        _rule("section", S, f"coalesce(loinc_code NOT IN ({_KNOWN}), true)", "warning", "loinc_code", "is not a known section type"),
        _rule("ingredient", I, _blank("substance_name"), "error", "substance_name", "is required"),
        _rule("ingredient", I, "ingredient_type = 'active' AND strength_numerator IS NULL", "warning", "strength_numerator", "is missing for an active ingredient"),
        _rule("ingredient", I, "strength_numerator <= 0", "error", "strength_numerator", "is not positive"),
        _rule("ingredient", I, "strength_denominator <= 0", "error", "strength_denominator", "is not positive"),
        _rule("ingredient", I, f"strength_numerator IS NOT NULL AND {_blank('strength_numerator_unit')}", "warning", "strength_numerator_unit", "is missing"),
        _rule("structure", M, f"spl_id NOT IN (SELECT spl_id FROM {S})", "warning", "sections", "no sections"),
        *[
            _rule("structure", M, f"spl_id NOT IN (SELECT spl_id FROM {S} WHERE loinc_code = '{c}' AND parent_section_id IS NULL)", "warning", "sections", f"no {t} section")
            for t, c in _CODES.items()
        ],
        _rule("structure", M, f"spl_id IN (SELECT spl_id FROM {S} WHERE section_id IS NOT NULL GROUP BY spl_id, section_id HAVING count(*) > 1)", "error", "section_id", "is repeated"),
        _rule("structure", M, f"spl_id NOT IN (SELECT spl_id FROM {I})", "warning", "ingredients", "no ingredients"),
        _rule("structure", M, f"spl_id IN (SELECT spl_id FROM {I}) AND spl_id NOT IN (SELECT spl_id FROM {I} WHERE ingredient_type = 'active')", "warning", "ingredients", "no active ingredients"),
    ]
)
_SCORE = "(" + " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in ("brand_name", "effective_date", "ndc_code", "document_code", "manufacturer")) + ") / 5.0"
ORACLE = {
    "validation_messages": _MESSAGES,
    "validation_summary": f"""
WITH m AS ({_MESSAGES}), c AS (SELECT spl_id, count(*) FILTER (severity = 'error') AS e, count(*) FILTER (severity = 'warning') AS w, count(*) AS n FROM m GROUP BY spl_id)
SELECT x.spl_id, coalesce(e, 0) AS n_errors, coalesce(w, 0) AS n_warnings, 0 AS n_info, coalesce(n, 0) AS n_issues, coalesce(e, 0) = 0 AS is_valid FROM {M} x LEFT JOIN c USING (spl_id)""",
    "latest_versions": """
SELECT set_id, version_number, spl_id, brand_name, marketing_status, updated_at FROM medications
QUALIFY row_number() OVER (PARTITION BY set_id, version_number ORDER BY updated_at DESC) = 1""",
    "version_history": """
SELECT event_id, user_id, ts, event_type, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS version,
  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AS is_latest FROM events""",
    "changed_files": """
WITH x AS (SELECT event_id, user_id, event_type, lag(event_type) OVER w AS b, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, event_type FROM x WHERE n = 1 OR event_type IS DISTINCT FROM b""",
    "first_events": "SELECT user_id, event_type, ts, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1",
    "key_collisions": "SELECT spl_id, count(DISTINCT (set_id, version_number)) AS n FROM medications GROUP BY spl_id HAVING n > 1",
    "catalog_stats": "SELECT count(*) AS n_files, CAST(coalesce(sum(n_chars), 0) AS BIGINT) AS total_size, max(ingested_at) AS last_at FROM documents",
    "batch_stats": """
WITH x AS (SELECT event_type <> 'error' AS ok, round(value, 4) AS s FROM events), y AS (SELECT ok, CASE WHEN s > 0 THEN s END AS t FROM x)
SELECT count(*) AS n, count(*) FILTER (ok) AS n_ok, round(count(*) FILTER (ok) * 100.0 / count(*), 6) AS success_rate, round(avg(t), 6) AS avg_seconds,
  max(t) AS max_seconds, min(t) AS min_seconds, round(sum(t), 4) AS total_seconds FROM y""",
    "top_errors": f"""
SELECT trim(string_split(processing_errors, ':')[1]) AS error, count(*) AS n FROM {M} WHERE processing_errors IS NOT NULL GROUP BY 1 ORDER BY n DESC, error LIMIT 5""",
    "quality_bands": f"""
WITH x AS (SELECT {_SCORE} AS s FROM {M})
SELECT CASE WHEN s >= 0.9 THEN 'excellent' WHEN s >= 0.7 THEN 'good' WHEN s >= 0.5 THEN 'fair' ELSE 'poor' END AS quality_band, count(*) AS n, round(avg(s), 6) AS avg_score FROM x GROUP BY 1""",
    "links_discover": f"""SELECT 'https://example.org/files/dm_spl_release_human_rx_' || spl_id || '.zip' AS url, 'dm_spl_release_human_rx_' || spl_id || '.zip' AS filename
FROM {M} WHERE document_code IS NOT NULL""",
    "hourly_events": "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "streamed_windows": "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "streamed_labels": """
SELECT * FROM medications WHERE set_id IS NOT NULL AND version_number IS NOT NULL QUALIFY row_number() OVER (PARTITION BY set_id, version_number ORDER BY updated_at DESC) = 1""",
}
