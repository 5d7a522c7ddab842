"""Readers of the relational label tables, with re-delivered rows resolved."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.session import materialize


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Columns of long texts: they are kept out of shuffles as far as possible.
LONG = {"section_text", "indication_text", "additional_data", "processing_errors"}


def latest(df: DataFrame, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one with the largest ``order``, ties by the column values.

    Null order values come first; rows with a null key are dropped. Copies of a hot key are
    combined before the shuffle. With long columns only keys are counted; rows whose key occurs
    once pass without a shuffle, and only those delivered again are aggregated whole. Hashes of the
    repeated keys are written, so Spark broadcasts them where their size allows and joins by a shuffle
    else; a key that only shares a hash is aggregated too, which leaves its row as it is.
    """
    rows = df.where(F.expr(" and ".join(f"`{k}` is not null" for k in keys)))
    if not LONG.intersection(columns):
        return _largest(rows, keys, columns, order)
    again = materialize(rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(F.xxhash64(*keys).alias("_key")))
    rows = rows.withColumn("_key", F.xxhash64(*keys))
    once = rows.join(again, "_key", "left_anti").select(*keys, *[c for c in columns if c not in keys])
    return once.unionByName(_largest(rows.join(again, "_key", "left_semi"), keys, columns, order))


def _largest(rows: DataFrame, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """A ``max`` over a struct, which combines before the shuffle."""
    rest = [c for c in dict.fromkeys([*order, *columns]) if c not in keys]
    picked = rows.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in columns if c not in keys])


def medications(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """Labels, one row per spl_id (the latest updated_at counts)."""
    return latest(read(spark, sf_dir, "medications"), ["spl_id"], ["spl_id", *columns], ["updated_at", "created_at"])


def children(spark: SparkSession, sf_dir: str, name: str, columns: list[str]) -> DataFrame:
    """Rows of a child table, one row per id (the latest created_at counts)."""
    return latest(read(spark, sf_dir, name), ["id"], ["id", *columns], ["created_at"])
