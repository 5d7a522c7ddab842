"""Rules over labels, sections and ingredients, as rows of messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.functions import clinical

UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
# Sections a label must have at its top level.
REQUIRED_TYPES = ["ACTIVE_INGREDIENT", "WARNINGS"]
# Known code systems.
CODE_SYSTEMS = [
    "2.16.840.1.113883.6.1",
    "2.16.840.1.113883.6.69",
    "2.16.840.1.113883.3.26.1.1",
    "2.16.840.1.113883.4.9",
    "2.16.840.1.113883.5.28",
    "2.16.840.1.113883.3.150",
]
MESSAGE = "struct<severity:string,field:string,message:string>"


def _message(when: Column, severity: str, field: str, message: str) -> Column:
    return F.when(when, F.struct(F.lit(severity).alias("severity"), F.lit(field).alias("field"), F.lit(message).alias("message")))


def required(field: str) -> Column:
    return _message(F.coalesce(F.trim(field), F.lit("")) == "", "error", field, "is required")


def uuid(field: str) -> Column:
    return _message(~F.coalesce(F.col(field).rlike(UUID), F.lit(True)), "error", field, "is not a UUID")


def date_text(field: str) -> Column:
    """Eight digits that are no date are an error, other texts a warning."""
    c = F.col(field)
    digits = c.rlike(r"^\d{8}$")
    valid = F.try_to_timestamp(c, F.lit("yyyyMMdd")).isNotNull()
    return F.coalesce(_message(~digits, "warning", field, "is not of the form yyyyMMdd"), _message(digits & ~valid, "error", field, "is not a date"))


def coded(field: str) -> list[Column]:
    """Rules of a struct(code, code_system, ...): both are required, the system should be a known one; a null struct breaks none."""
    c = F.col(field)
    lacks = lambda part: c.isNotNull() & (F.coalesce(F.trim(c[part]), F.lit("")) == "")
    unknown = F.coalesce((c["code_system"] != "") & ~c["code_system"].isin(*CODE_SYSTEMS), F.lit(False))
    return [
        _message(lacks("code"), "error", f"{field}.code", "is required"),
        _message(lacks("code_system"), "error", f"{field}.code_system", "is required"),
        _message(unknown, "warning", f"{field}.code_system", "is not a known code system"),
    ]


def document_messages(docs: DataFrame) -> DataFrame:
    """Rules of parsed documents that the tables can't show any more: dates as written and code systems."""
    rows = docs.where("success").withColumnRenamed("document_id", "spl_id")
    return messages(rows, "spl_id", "document", [date_text("effective_time"), *coded("document_code")])


def parsed_section_messages(sections: DataFrame) -> DataFrame:
    """The same of parsed sections of all depths."""
    rows = sections.withColumnRenamed("document_id", "spl_id")
    return messages(rows, "spl_id", "section", [date_text("effective_time"), *coded("section_code")])


def parsed_product_messages(products: DataFrame) -> DataFrame:
    """The same of parsed products."""
    return messages(products.withColumnRenamed("document_id", "spl_id"), "spl_id", "product", coded("product_code"))


def messages(df: DataFrame, key: str, kind: str, rules: list[Column]) -> DataFrame:
    """key, context, severity, field, message: one row per broken rule."""
    found = F.array_compact(F.array(*rules))
    return df.select(key, F.lit(kind).alias("context"), F.inline(found))


def label_messages(meds: DataFrame) -> DataFrame:
    return messages(
        meds, "spl_id", "label",
        [
            required("spl_id"), uuid("spl_id"), required("set_id"), uuid("set_id"), required("document_code"),
            _message(F.col("effective_date").isNull(), "warning", "effective_date", "is missing"),
            _message(F.coalesce(F.col("version_number") < 1, F.lit(True)), "error", "version_number", "is not positive"),
        ],
    )


def section_messages(sections: DataFrame) -> DataFrame:
    known = F.col("loinc_code").isin(*clinical.SECTIONS)
    return messages(
        sections, "spl_id", "section",
        [required("section_id"), uuid("section_id"), _message(F.coalesce(~known, F.lit(True)), "warning", "loinc_code", "is not a known section type")],
    )


def ingredient_messages(ingredients: DataFrame) -> DataFrame:
    active = F.col("ingredient_type") == "active"
    n, d = F.col("strength_numerator"), F.col("strength_denominator")
    return messages(
        ingredients, "spl_id", "ingredient",
        [
            required("substance_name"),
            _message(active & n.isNull(), "warning", "strength_numerator", "is missing for an active ingredient"),
            _message(n <= 0, "error", "strength_numerator", "is not positive"),
            _message(d <= 0, "error", "strength_denominator", "is not positive"),
            _message(n.isNotNull() & (F.coalesce(F.trim("strength_numerator_unit"), F.lit("")) == ""), "warning", "strength_numerator_unit", "is missing"),
        ],
    )


def structure_messages(meds: DataFrame, sections: DataFrame, ingredients: DataFrame) -> DataFrame:
    """Labels without sections, without a required section type, without ingredients or active ones, with repeated section ids."""
    kind = clinical.section_type(F.col("loinc_code"))
    there = sections.groupBy("spl_id").agg(F.count("*").alias("n"), F.collect_set(F.when(F.col("parent_section_id").isNull(), kind)).alias("types"))
    repeated = sections.where("section_id is not null").groupBy("spl_id", "section_id").count().where("count > 1").select("spl_id").distinct().withColumn("repeated", F.lit(True))
    drugs = ingredients.groupBy("spl_id").agg(F.count("*").alias("n_drugs"), F.count_if(F.col("ingredient_type") == "active").alias("n_active"))
    rows = meds.select("spl_id").join(there, "spl_id", "left").join(repeated, "spl_id", "left").join(drugs, "spl_id", "left")
    lacks = lambda t: ~F.array_contains(F.coalesce("types", F.array().cast("array<string>")), t)
    return messages(
        rows, "spl_id", "structure",
        [
            _message(F.col("n").isNull(), "warning", "sections", "no sections"),
            *[_message(lacks(t), "warning", "sections", f"no {t} section") for t in REQUIRED_TYPES],
            _message(F.coalesce("repeated", F.lit(False)), "error", "section_id", "is repeated"),
            _message(F.col("n_drugs").isNull(), "warning", "ingredients", "no ingredients"),
            _message(F.col("n_drugs").isNotNull() & (F.col("n_active") == 0), "warning", "ingredients", "no active ingredients"),
        ],
    )


def summary(found: DataFrame, meds: DataFrame) -> DataFrame:
    """Per label the messages by severity and in all; a label without errors is valid."""
    counts = found.groupBy("spl_id").agg(
        *[F.count_if(F.col("severity") == k).alias(n) for k, n in (("error", "n_errors"), ("warning", "n_warnings"), ("info", "n_info"))], F.count("*").alias("n_issues")
    )
    out = meds.select("spl_id").join(counts, "spl_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("spl_id", zero("n_errors"), zero("n_warnings"), zero("n_info"), zero("n_issues"), (F.coalesce("n_errors", F.lit(0)) == 0).alias("is_valid"))
