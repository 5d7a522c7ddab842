"""History of changing attributes from periodic snapshots, by Merkle comparison.

Keys fall into leaf buckets, about ``LEAF_KEYS`` keys each. A bucket's hash is the order-free sum
of its rows' hashes, an inner node's that of its children. Every snapshot is hashed once and its
hash table is stored with it; snapshots are laid out by the branches below the root. Two snapshots
are compared from the root: only branches whose hashes differ are descended, only the rows of
differing leaves are read and compared, and the versions that are new or changed are appended.
What has been appended is never written again: which version is current is told on reading.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelmill.session import materialize, shared_dir

#: Children of an inner node; keys of a leaf, on average; most levels below the root.
FANOUT, LEAF_KEYS, MOST_LEVELS = 16, 64, 7
#: Time of deliveries without one.
_FIRST = "1900-01-01"


def depth_for(n_keys: int) -> int:
    """Levels below the root, so that a leaf has about ``LEAF_KEYS`` keys."""
    return min(MOST_LEVELS, max(1, math.ceil(math.log(max(1, n_keys / LEAF_KEYS), FANOUT))))


def _leaf(keys: Sequence[str], depth: int = 3) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(FANOUT**depth)).cast("int")


def _hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*columns).cast("decimal(38,0)")


def inner_levels(leaves: DataFrame, depth: int) -> list[DataFrame]:
    """Hash tables (node, h) of the levels 1..depth over a stored table of leaves; the last has the leaves."""
    levels = [leaves]
    for _ in range(depth - 1):
        levels.insert(0, levels[0].groupBy(F.floor(F.col("node") / FANOUT).cast("int").alias("node")).agg(F.sum("h").alias("h")))
    return levels


def merkle_levels(state: DataFrame, keys: Sequence[str], values: Sequence[str], depth: int = 3) -> list[DataFrame]:
    """Hash tables (node, h) of the levels 1..depth of a state; the leaves are hashed once and written."""
    return inner_levels(materialize(state.groupBy(_leaf(keys, depth).alias("node")).agg(F.sum(_hash([*keys, *values])).alias("h"))), depth)


def differing_leaves(old: list[DataFrame], new: list[DataFrame]) -> DataFrame:
    """Leaves whose hashes differ, found by descending only into differing nodes."""
    branches = None
    for a, b in zip(old, new, strict=True):
        if branches is not None:
            parents = branches.select(F.col("node").alias("_parent"))
            a = a.join(parents, F.floor(a.node / FANOUT).cast("int") == parents._parent, "left_semi")
            b = b.join(parents, F.floor(b.node / FANOUT).cast("int") == parents._parent, "left_semi")
        branches = (
            a.select("node", F.col("h").alias("_a"))
            .join(b.select("node", F.col("h").alias("_b")), "node", "full")
            .where(~F.col("_a").eqNullSafe(F.col("_b")))
            .select("node")
        )
    return branches


def _laid_out(df: DataFrame, depth: int) -> DataFrame:
    """Written by branch, the first level's node of ``node``, so that readers of some branches leave the others alone."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/labelmill-{uuid.uuid4().hex}"
    branch = F.floor(F.col("node") / FANOUT ** (depth - 1)).cast("int")
    df.withColumn("_branch", branch).repartition("_branch").write.partitionBy("_branch").parquet(path)
    schema = df.schema.add("_branch", "integer")
    return spark.read.schema(schema).parquet(path)


def _read_leaves(table: DataFrame, leaves: DataFrame, depth: int) -> DataFrame:
    """The rows of some leaves; their branches are the partitions that are read."""
    some = leaves.select(F.floor(F.col("node") / FANOUT ** (depth - 1)).cast("int").alias("_branch"), "node")
    return table.join(some, ["_branch", "node"], "left_semi").drop("_branch", "node")


def _current(appended: list[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The appended versions as one table with is_current: the last of a key's latest batch."""
    both = reduce(lambda x, y: x.unionByName(y), appended)
    latest = F.max("_batch").over(Window.partitionBy(*keys))
    return both.withColumn("is_current", F.col("_last") & (F.col("_batch") == latest)).drop("_last", "_batch")


def delivered_history(rows: DataFrame, keys: Sequence[str], values: Sequence[str], delivered: str, cuts: int = 3) -> DataFrame:
    """All delivered states of a table of deliveries: keys, values, recorded_at, delivered_at, is_current.

    A snapshot is taken at ``cuts`` evenly filled points in time and at the end. Besides the hash of
    its state a row of a snapshot has that of its journal, the distinct states delivered since the
    last snapshot (of a key without deliveries: its state), so a leaf differs too if a state was
    delivered and replaced, or taken back, between two cuts. In the differing leaves every delivery
    of the period that changes its key's values becomes a version, in order of time. Ties go to the
    larger values, which come last. delivered_at is null for rows without a delivery time, which
    count as delivered first. Rows with a null key are left out; no rows give no history.
    """
    columns, names = [*keys, *values], [f"_v{i}" for i in range(len(values))]
    timed = _timed(rows, keys, delivered)
    points, n_keys = _points(timed, keys, cuts)
    depth = depth_for(n_keys)
    # The deliveries are read once: laid out by leaf, with the number of their period.
    at = F.unix_micros("_at")
    period = F.lit(0)
    for _, p in points[:-1]:
        period = period + F.when(at > F.lit(p), 1).otherwise(0)
    plain = timed.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(v).alias(n) for v, n in zip(values, names, strict=True)], "_at", period.alias("_period"))
    ks = [f"_k{i}" for i in range(len(keys))]
    table = _laid_out(plain.withColumn("node", _leaf(ks, depth)), depth)
    by_key = Window.partitionBy(*ks).orderBy("_at", F.struct(*names))
    appended, before, tree = [], None, None
    for k, (name, _) in enumerate(points):
        part = table.where(F.col("_period") == k)
        journal = part.select(*ks, _hash([*ks, *names]).alias("_h")).distinct().groupBy(*ks).agg(F.sum("_h").alias("_journal"))
        states = part.select(*ks, "node", "_at", *names)
        states = states if before is None else states.unionByName(before.select(*ks, "node", F.lit("0001-01-01").cast("timestamp").alias("_at"), *names))
        last = states.groupBy(*ks, "node").agg(F.max(F.struct("_at", *names)).alias("_r")).select(*ks, "node", *[F.col(f"_r.{n}").alias(n) for n in names])
        hashed = last.join(journal, ks, "left").withColumn("_h", _hash([*ks, *names]))
        snapshot = hashed.withColumn("_journal", F.coalesce("_journal", "_h"))
        if k + 1 < len(points):  # the last one isn't compared with again
            snapshot = _laid_out(snapshot, depth)
        stored = materialize(snapshot.groupBy("node").agg(F.sum("_h").alias("h"), F.sum("_journal").alias("j")))
        here = part.drop("_period")
        if before is None:
            here = here.drop("node", "_branch").withColumn("_new", F.lit(True))
        else:
            new = stored.select("node", F.col("j").alias("h"))
            leaves = differing_leaves(inner_levels(tree, depth), inner_levels(new, depth))
            # The state before the period stands before all its deliveries.
            there = _read_leaves(before.select(*ks, *names, "node", "_branch"), leaves, depth).withColumn("_at", F.lit("0001-01-01").cast("timestamp"))
            here = _read_leaves(here, leaves, depth).withColumn("_new", F.lit(True)).unionByName(there.withColumn("_new", F.lit(False)))
        state = F.struct(*names)
        marked = here.withColumn("_before", F.lag(F.struct(F.lit(1), state)).over(by_key))
        marked = marked.where(F.col("_new") & ~F.struct(F.lit(1), state).eqNullSafe(F.col("_before")))
        fresh = marked.withColumn("_last", F.lead(F.lit(True)).over(by_key).isNull()).select(
            *[F.col(c).alias(o) for c, o in zip([*ks, *names], columns, strict=True)],
            F.lit(name).alias("recorded_at"), F.nullif("_at", F.lit(_FIRST).cast("timestamp")).alias("delivered_at"), F.lit(k).alias("_batch"), "_last",
        )
        appended.append(materialize(fresh))
        before, tree = snapshot, stored.select("node", "h")
    return _current(appended, keys)


def snapshot_history(snapshots: Sequence[tuple[str, DataFrame]], keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """All recorded versions: keys, values, recorded_at (a snapshot's name), is_current.

    ``snapshots`` are (name, state) in time order, a state having at most one row per key. A key
    that vanishes keeps its last version (deliveries only add or correct). A key whose values
    change gets a new version, the older one isn't current any more. Equal states add nothing;
    empty ones are allowed. Null values are compared as values.
    """
    columns = [*keys, *values]
    depth, appended, before, tree = None, [], None, None
    for k, (name, state) in enumerate(snapshots):
        state = state.select(*columns)
        if depth is None:
            depth = depth_for(state.count())
        snapshot = _laid_out(state.withColumn("node", _leaf(keys, depth)), depth)
        stored = materialize(snapshot.groupBy("node").agg(F.sum(_hash(columns)).alias("h")))
        fresh = snapshot.drop("node", "_branch")
        if before is not None:
            leaves = differing_leaves(inner_levels(tree, depth), inner_levels(stored, depth))
            there, here = _read_leaves(before, leaves, depth), _read_leaves(snapshot, leaves, depth)
            same = reduce(lambda x, y: x & y, [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in columns])
            fresh = here.alias("n").join(there.alias("o"), same, "left_anti")
        appended.append(materialize(fresh.select(*columns, F.lit(name).alias("recorded_at"), F.lit(k).alias("_batch"), F.lit(True).alias("_last"))))
        before, tree = snapshot, stored
    return _current(appended, keys)


def periods_in_force(versions: DataFrame, key: str, version: str, effective: str) -> DataFrame:
    """Periods ``[valid_from, valid_to)`` per version: on a day the highest version already effective holds.

    A version without a day in force has no row; an open end is null. Versions without key, number
    or date don't count; ``versions`` has one row per key and number.
    """
    rows = versions.where(F.col(key).isNotNull() & F.col(version).isNotNull() & F.col(effective).isNotNull())
    higher = Window.partitionBy(key).orderBy(F.col(version).desc()).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("valid_from", F.col(effective))
        .withColumn("valid_to", F.min(effective).over(higher))
        .where(F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to")))
    )


def delivered_snapshots(rows: DataFrame, keys: Sequence[str], values: Sequence[str], delivered: str, cuts: int = 3) -> list[tuple[str, DataFrame]]:
    """States of a table of deliveries at ``cuts`` evenly filled points in time and at the end.

    In a state the latest delivery of a key counts; ties go to the larger values. Rows without a
    delivery time count as delivered first.
    """
    rows = _timed(rows, keys, delivered)
    out = []
    for name, p in _points(rows, keys, cuts)[0]:
        part = rows if p is None else rows.where(F.unix_micros("_at") <= F.lit(p))
        latest = part.groupBy(*keys).agg(F.max(F.struct("_at", *values)).alias("_r"))
        out.append((name, latest.select(*keys, *[F.col(f"_r.{v}").alias(v) for v in values])))
    return out


def _timed(rows: DataFrame, keys: Sequence[str], delivered: str) -> DataFrame:
    """Rows whose keys aren't null, with ``_at``."""
    at = F.coalesce(F.col(delivered).cast("timestamp"), F.lit(_FIRST).cast("timestamp"))
    return rows.where(reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])).withColumn("_at", at)


def _points(rows: DataFrame, keys: Sequence[str], cuts: int) -> tuple[list[tuple[str, int | None]], int]:
    """(name, microseconds) of the snapshots, the last being the end, and about how many keys there are."""
    got = rows.agg(
        F.percentile_approx(F.unix_micros("_at"), [(i + 1) / (cuts + 1) for i in range(cuts)]).alias("p"), F.approx_count_distinct(F.struct(*keys)).alias("n")
    ).first()  # a bounded list: one number per cut
    return [(f"s{k}", p) for k, p in enumerate([*dict.fromkeys(got["p"] or []), None])], got["n"]
