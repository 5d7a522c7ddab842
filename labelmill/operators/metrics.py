"""Run and catalogue figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def catalog_stats(df: DataFrame, size: str, at: str) -> DataFrame:
    """n_files, total_size, last_at: one row, 0, 0 and null for an empty table."""
    return df.agg(F.count("*").alias("n_files"), F.coalesce(F.sum(size), F.lit(0)).alias("total_size"), F.max(at).alias("last_at"))


def batch_stats(df: DataFrame, ok: str, seconds: str) -> DataFrame:
    """n, n_ok, success_rate (0 of none), and avg, max, min, total of positive times."""
    took = F.when(F.col(seconds) > 0, F.col(seconds))
    return df.agg(
        F.count("*").alias("n"), F.count_if(F.col(ok)).alias("n_ok"),
        F.coalesce(F.round(F.try_divide(F.count_if(F.col(ok)) * 100.0, F.count("*")), 6), F.lit(0.0)).alias("success_rate"),
        F.round(F.avg(took), 6).alias("avg_seconds"), F.max(took).alias("max_seconds"), F.min(took).alias("min_seconds"), F.round(F.sum(took), 4).alias("total_seconds"),
    )


def top_errors(df: DataFrame, error: str, k: int = 5) -> DataFrame:
    """The k most frequent kinds of errors (the text before a colon), ties by name."""
    kind = F.trim(F.substring_index(F.col(error), ":", 1)).alias("error")
    return df.where(F.col(error).isNotNull()).groupBy(kind).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "error").limit(k)


def compare_batches(df: DataFrame, batch: str, ok: str, seconds: str) -> DataFrame:
    """One row over batches of files: n_batches, avg, best and worst success rate, avg_batch_seconds, n_files, n_ok; zeros and nulls of none."""
    each = df.groupBy(batch).agg(
        (F.count_if(F.col(ok)) * 100.0 / F.count("*")).alias("_rate"), F.sum(seconds).alias("_s"), F.count("*").alias("_n"), F.count_if(F.col(ok)).alias("_k")
    )
    return each.agg(
        F.count("*").alias("n_batches"), F.round(F.avg("_rate"), 6).alias("avg_success_rate"), F.round(F.max("_rate"), 6).alias("best_success_rate"),
        F.round(F.min("_rate"), 6).alias("worst_success_rate"), F.round(F.avg("_s"), 4).alias("avg_batch_seconds"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_files"), F.coalesce(F.sum("_k"), F.lit(0)).alias("n_ok"),
    )


def files_per_category(df: DataFrame, category: str) -> DataFrame:
    """category, n_files; files without a category count under ''."""
    return df.groupBy(F.coalesce(category, F.lit("")).alias("category")).agg(F.count("*").alias("n_files"))


def missing_files(tracked: DataFrame, listing: DataFrame, name: str) -> DataFrame:
    """Tracked entries that are still there."""
    return tracked.join(listing.select(name).distinct(), name, "left_semi")


def quality_bands(df: DataFrame, checks: list[str]) -> DataFrame:
    """Adds quality_score (share of checks passed, nulls fail) and quality_band."""
    passed = sum((F.when(F.coalesce(F.expr(c), F.lit(False)), 1).otherwise(0) for c in checks), F.lit(0))
    score = passed / F.lit(float(len(checks)))
    band = F.when(score >= 0.9, "excellent").when(score >= 0.7, "good").when(score >= 0.5, "fair").otherwise("poor")
    return df.withColumn("quality_score", score).withColumn("quality_band", band)
