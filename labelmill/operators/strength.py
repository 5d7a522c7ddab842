"""Strengths in common units, and equal strengths written differently."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.functions.unitseg import quantity
from labelmill.session import materialize

#: Relative difference up to which two quantities are equal.
TOLERANCE = 0.001


def with_common_units(
    df: DataFrame,
    num: str = "strength_numerator",
    num_unit: str = "strength_numerator_unit",
    den: str = "strength_denominator",
    den_unit: str = "strength_denominator_unit",
) -> DataFrame:
    """Adds quantity_value (in g, L, h, IU, Eq, mol, m or pieces) and quantity_kind (``mass/volume``).

    Both are null where number or unit can't be read. See :mod:`labelmill.functions.unitseg`.
    """
    out = df.withColumn("_common_quantity", quantity(F.col(num), F.col(num_unit), F.col(den), F.col(den_unit)))
    return out.withColumn("quantity_value", F.col("_common_quantity.value")).withColumn("quantity_kind", F.col("_common_quantity.kind")).drop("_common_quantity")


def equal_but_written_differently(df: DataFrame, key: list[str], id: str, notation: list[str]) -> DataFrame:
    """Pairs (id_a, id_b), id_a < id_b, with equal ``key`` and quantity but different ``notation``.

    Rows of one key, quantity and notation form a class; classes are joined on buckets of the
    logarithm as wide as the tolerance (a class is looked up in its own and the two next
    buckets), then expanded to the rows' pairs. Null keys and quantities make no pair.
    """
    ready = df.where(F.col("quantity_value").isNotNull())
    for k in key:
        ready = ready.where(F.col(k).isNotNull())
    notations = F.xxhash64(*key, "quantity_kind", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in notation])
    # Written, so that the units are read once and not again for each side of the joins.
    ready = materialize(ready.select(*key, F.col(id).alias("_id"), "quantity_kind", "quantity_value", notations.alias("_class")))
    classes = ready.groupBy(*key, "quantity_kind", "_class").agg(F.min("quantity_value").alias("_v"))
    width = F.lit(TOLERANCE)
    classes = classes.withColumn("_b", F.when(F.col("_v") > 0, F.floor(F.log("_v") / width)).otherwise(F.lit(-(2**60))))
    left = classes.withColumn("_b", F.explode(F.array(F.col("_b") - 1, F.col("_b"), F.col("_b") + 1)))
    a, b = left.alias("a"), classes.alias("b")
    on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in [*key, "quantity_kind", "_b"]]
    close = F.abs(F.col("a._v") - F.col("b._v")) <= width * F.greatest("a._v", "b._v")
    pairs = a.join(b, on).where((F.col("a._class") < F.col("b._class")) & close).select(
        F.col("a._class").alias("_x"), F.col("b._class").alias("_y")
    )
    x = ready.select(F.col("_class").alias("_x"), F.col("_id").alias("_i"))
    y = ready.select(F.col("_class").alias("_y"), F.col("_id").alias("_j"))
    rows = pairs.join(x, "_x").join(y, "_y").where("_i != _j")
    return rows.select(F.least("_i", "_j").alias("id_a"), F.greatest("_i", "_j").alias("id_b")).distinct()
