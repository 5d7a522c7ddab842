"""Writing by key: upserts, replacement of children, deletion of documents, versions and changes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def upsert(current: DataFrame, incoming: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key of both: the one with the largest ``order``, incoming rows before current ones in ties.

    Whole rows replace whole rows; columns of only one side are null on the other. Rows with a
    null in a key identify nothing and are left out; :func:`without_key` has them for quarantine.
    """
    current, incoming = (df.where(_keyed(keys)) for df in (current, incoming))
    both = current.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in (*keys, "_new", order)]
    best = both.groupBy(*keys).agg(F.max(F.struct(order, "_new", *rest)).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in (order, *rest)])


def _keyed(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def without_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that :func:`upsert` leaves out."""
    return df.where(~_keyed(keys))


def replace_children(current: DataFrame, incoming: DataFrame, parent: str) -> DataFrame:
    """All children of the parents in ``incoming`` are replaced by its rows."""
    kept = current.join(incoming.select(parent).distinct(), parent, "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def delete_documents(tables: dict[str, DataFrame], ids: DataFrame, key: str = "spl_id") -> dict[str, DataFrame]:
    """The tables without the rows of the given documents."""
    gone = ids.select(key).distinct()
    return {name: df.join(gone, key, "left_anti") for name, df in tables.items()}


def key_collisions(df: DataFrame, key: str, identity: list[str]) -> DataFrame:
    """Keys that stand for more than one identity: they go to quarantine instead of overwriting each other."""
    seen = df.groupBy(key).agg(F.count_distinct(F.struct(*identity)).alias("n"))
    return seen.where("n > 1")


def numbered_versions(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Adds version (1, 2, ... per key in order) and is_latest."""
    w = Window.partitionBy(key).orderBy(*order)
    back = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("version", F.row_number().over(w)).withColumn("is_latest", F.row_number().over(back) == 1)


def changes(df: DataFrame, key: str, order: list[str], values: list[str]) -> DataFrame:
    """Adds is_changed: the first row of a key, or one whose values differ from the row before (nulls are equal)."""
    w = Window.partitionBy(key).orderBy(*order)
    now = F.struct(*values)
    before = F.lag(now).over(w)
    return df.withColumn("is_changed", F.row_number().over(w).eqNullSafe(F.lit(1)) | ~now.eqNullSafe(before))


def dedup_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key, others go."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min(F.struct(*order, *[c for c in rest if c not in order])).alias("_r"))
    return first.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
