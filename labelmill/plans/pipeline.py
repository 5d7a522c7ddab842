"""From label files to tables: read, parse, load, validate, write, report."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.operators import document as D
from labelmill.operators import validation
from labelmill.operators.metrics import top_errors
from labelmill.plans import views
from labelmill.session import materialize
from labelmill.sources.label_xml import parse, read_xml_dir, read_xml_zip


@dataclass(frozen=True)
class Options:
    """``archives``: the folder holds archives of archives; ``recursive``: sub-folders too; ``strict``: a bad document fails the run.

    ``strict_validation``: a broken rule of severity error fails the run. ``json``: the report, the
    documents and the messages are written as JSON lines too.
    """

    archives: bool = False
    recursive: bool = True
    strict: bool = False
    strict_validation: bool = False
    json: bool = False
    write_mode: str = "overwrite"


def run(spark: SparkSession, path: str, target: str, options: Options = Options()) -> dict[str, DataFrame]:
    """Loads a folder of labels into Parquet tables under ``target``; returns all written tables by name.

    Besides the five relational tables, which have all columns the views read, there are
    ``quarantine`` (what isn't a label), ``messages`` (broken rules), ``validation`` (their counts by
    label), ``documents`` (one row a file: path, document_id, success, error, warnings and counts)
    and ``report`` (one row of sums). An empty folder gives empty tables. Of documents with the
    same id in several files each is loaded; resolve them with ``upsert``.
    """
    raw = read_xml_zip(spark, path).withColumn("path", F.concat_ws("/", "archive", "inner", "name")) if options.archives else read_xml_dir(spark, path, options.recursive)
    parsed = materialize(parse(raw.select("path", "xml")))
    bad = D.quarantine(parsed)
    if options.strict:
        bad = bad.withColumn("xml", F.raise_error(F.concat(F.lit("not a label document: "), "path")).cast("string"))
    now = F.lit(spark.sql("select current_timestamp() as t").first()["t"])
    out: dict[str, DataFrame] = {}

    def write(name: str, df: DataFrame) -> None:
        df.write.mode(options.write_mode).parquet(f"{target}/{name}.parquet")
        out[name] = spark.read.parquet(f"{target}/{name}.parquet")

    for name, df in {**D.load_tables(parsed, now), "quarantine": bad}.items():
        write(name, df)
    docs, products = D.documents(parsed), D.products(parsed)
    found = [
        validation.label_messages(out["medications"]), validation.section_messages(out["spl_sections"]), validation.ingredient_messages(out["ingredients"]),
        validation.structure_messages(out["medications"], out["spl_sections"], out["ingredients"]), validation.document_messages(docs),
        validation.parsed_section_messages(D.all_sections(parsed)), validation.parsed_product_messages(products),
    ]
    broken = reduce(DataFrame.unionByName, found)
    if options.strict_validation:
        broken = broken.withColumn("message", F.when(F.col("severity") == "error", F.raise_error(F.concat_ws(" ", F.lit("invalid label"), "spl_id", "field", "message")).cast("string")).otherwise(F.col("message")))
    write("messages", broken)
    write("validation", validation.summary(out["messages"], out["medications"]))
    counts = {
        "n_sections": out["spl_sections"].groupBy(F.col("spl_id").alias("document_id")), "n_products": products.groupBy("document_id"),
        "n_active": out["ingredients"].where("ingredient_type = 'active'").groupBy(F.col("spl_id").alias("document_id")),
    }
    error = F.nullif(F.array_join("processing_errors", "; "), F.lit(""))
    rows = docs.select("path", "document_id", "success", F.when(~F.col("success"), error).alias("error"), F.when(F.col("success"), error).alias("warnings"))
    for name, grouped in counts.items():
        rows = rows.join(grouped.agg(F.count("*").alias(name)), "document_id", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    write("documents", rows)
    sums = out["documents"].agg(
        F.count("*").alias("n_files"), F.count_if("success").alias("n_labels"), F.count_if(~F.col("success")).alias("n_failed"),
        F.coalesce(F.round(F.try_divide(F.count_if("success") * 100.0, F.count("*")), 4), F.lit(0.0)).alias("success_rate"),
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts],
    )
    valid = out["validation"].agg(
        F.count_if("is_valid").alias("n_valid"), F.count_if(~F.col("is_valid")).alias("n_invalid"),
        F.coalesce(F.round(F.try_divide(F.count_if("is_valid") * 100.0, F.count("*")), 4), F.lit(0.0)).alias("validation_rate"),
    )
    write("report", sums.withColumn("_one", F.lit(1)).join(valid.withColumn("_one", F.lit(1)), "_one").drop("_one"))  # one row each
    if options.json:
        for name in ("report", "documents", "messages", "validation"):
            out[name].write.mode(options.write_mode).json(f"{target}/{name}.jsonl")
    return out


def error_report(parsed: DataFrame, k: int = 5) -> DataFrame:
    """The most frequent processing errors of parsed documents."""
    return top_errors(D.documents(parsed).select(F.explode("processing_errors").alias("error")), "error", k)


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """The three search views, for SQL."""
    for name in ("medication_search", "section_content", "active_ingredients_summary"):
        views.QUERIES[name](spark, sf_dir).createOrReplaceTempView(name)


def high_confidence(items: str, threshold: float = 0.8):
    """The elements of an array of extracted facts whose confidence_score reaches the threshold; null stays null."""
    return F.filter(F.col(items), lambda x: x["confidence_score"] >= threshold)


def needs_review(items: str, threshold: float = 0.8):
    """The others, those without a score included."""
    return F.filter(F.col(items), lambda x: F.coalesce(x["confidence_score"], F.lit(0.0)) < threshold)
