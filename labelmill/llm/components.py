"""Connected components of links, by distributed joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.session import materialize


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (its smallest node), one row per node of a link.

    In a round every node takes the smallest label among its own and its neighbours', then the
    label of that label; a chain of n links needs about log2(n) rounds. No component is gathered
    in one task; a hub's links are pre-aggregated before the shuffle.
    """
    both = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    both = materialize(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    label = materialize(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("component")))
    while True:
        around = both.join(label.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("component").alias("near"))
        near = label.join(around, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = near.select(F.col("node").alias("component"), F.col("component").alias("far"))
        new = materialize(
            near.join(jump, "component", "left").select("node", "old", F.least("component", F.coalesce("far", "component")).alias("component"))
        )
        if new.where("old != component").isEmpty():
            return new.select("node", "component")
        label = new.select("node", "component")
