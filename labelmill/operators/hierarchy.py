"""Parent-child rows into full hierarchies: root, depth, path, descendants and cycles.

1. Rows are placed in fragments (by a locality key, cut by a hash where it is large); in each
   fragment the parent chains are contracted: every node points to its fragment's exit, the node
   from which the chain leaves the fragment, ends, or runs in a circle.
2. The nodes to which chains of other fragments lead form a smaller quotient forest. It is solved
   by the same function: in one fragment once it has at most ``FRAGMENT_ROWS`` nodes; before that
   its fragments are stars, a parent with those of its children that a coin drawn from their ids
   assigns to it, so that a level takes away a quarter of a chain's nodes and all leaves.
3. Fragment results (exit, distance, path) are expanded by the quotient's. A circle within a
   fragment is seen there, one over several fragments closes within some level's fragment.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelmill.session import materialize

#: Most rows of a fragment, on average; a locality key with more is split.
FRAGMENT_ROWS = 100_000
CYCLE = "cycle"
_STEP = T.StructType([T.StructField("id", T.StringType()), T.StructField("place", T.LongType())])
_LOCAL = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("exit_id", T.StringType()),
        T.StructField("hops", T.LongType()),
        T.StructField("above", T.StringType()),
        T.StructField("onward", T.LongType()),
        T.StructField("loop", T.BooleanType()),
        T.StructField("way", T.ArrayType(_STEP)),
    ]
)


def _contract(parents: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per node its exit, the weight and the steps to it and whether its chain runs in a circle; -1 is no local parent.

    Pointer doubling: after k rounds a node has jumped min(2 ** k, its depth) steps.
    """
    n = len(parents)
    jump = np.where(parents >= 0, parents, np.arange(n))
    steps = (parents >= 0).astype(np.int64)
    weight = np.where(parents >= 0, weights, 0).astype(np.int64)
    for _ in range(math.ceil(math.log2(n + 1)) + 1):
        if not steps[jump].any():
            break
        steps, weight, jump = steps + steps[jump], weight + weight[jump], jump[jump]
    return jump, weight, steps, parents[jump] >= 0


def _ways(parents: np.ndarray, steps: np.ndarray, ways: pa.ListArray) -> pa.ListArray:
    """Per node the joined ways of the nodes from its exit down to itself; ``steps`` is -1 for nodes without one."""
    ends = np.cumsum(steps + 1)
    nodes = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    at, spot = np.flatnonzero(steps >= 0), ends[steps >= 0] - 1
    first = (ends - steps - 1)[steps >= 0]
    while len(at):
        nodes[spot] = at
        more = spot > first
        at, spot, first = parents[at[more]], spot[more] - 1, first[more]
    taken = ways.take(pa.array(nodes))
    length = np.concatenate([[0], np.cumsum(pc.list_value_length(taken).to_numpy(zero_copy_only=False).astype(np.int64))])
    return pa.ListArray.from_arrays(pa.array(length[np.concatenate([[0], ends])].astype(np.int32)), taken.flatten())


def _fragment(rows: pa.Table) -> pa.Table:
    """Contracts one fragment (id, parent, weight, dead, way)."""
    rows = rows.combine_chunks()
    ids, above = rows["id"].combine_chunks(), rows["parent"].combine_chunks()
    dead = rows["dead"].to_numpy()
    found = pc.index_in(above, value_set=ids)
    parents = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    parents[pc.is_null(above).to_numpy(zero_copy_only=False) | dead] = -1
    weights = rows["weight"].to_numpy()
    jump, weight, steps, loop = _contract(parents, weights)
    loop = loop | dead[jump]
    exits = pa.array(jump, mask=loop)
    way = rows["way"].combine_chunks()
    if way.null_count < len(way):
        way = _ways(parents, np.where(loop, -1, steps), way)
    arrays = [ids, ids.take(exits), pa.array(weight, mask=loop), above.take(exits), pa.array(weights).take(exits), pa.array(loop), way]
    return pa.Table.from_arrays(arrays, names=_LOCAL.names)


def _placed(fragment_rows: int, total: int, level: int) -> Column:
    """The fragment of a quotient node: one for all if they fit, else stars by a coin from the ids."""
    if total <= fragment_rows:
        return F.lit("0")
    coin = lambda c: F.pmod(F.xxhash64(F.lit(level), c), F.lit(2)) == 0
    star = F.when(F.col("parent").isNotNull() & ~coin("id") & coin("parent"), F.col("parent")).otherwise(F.col("id"))
    return F.pmod(F.xxhash64(star, F.lit(17)), F.lit(math.ceil(4 * total / fragment_rows))).cast("string")


def _forest(nodes: DataFrame, fragment_rows: int, level: int = 1) -> DataFrame:
    """(id, root_id, depth, loop, way) of nodes (id, parent, weight, dead, way, frag): everything of a forest, exact.

    ``weight`` is the distance to the parent, ``way`` what a path lists for the node (null if no
    paths are wanted), ``dead`` marks nodes of known circles.
    """
    local = materialize(nodes.groupBy("frag").applyInArrow(_fragment, _LOCAL))
    led = local.where("not loop and above is not null").select(F.col("above").alias("id")).distinct()
    quotient = materialize(local.join(led, "id", "left_semi"))
    n = quotient.count()
    if n == 0:
        return local.select("id", F.col("exit_id").alias("root_id"), F.col("hops").alias("depth"), "loop", "way")
    inner = quotient.select(
        "id", F.col("above").alias("parent"), (F.coalesce("hops", F.lit(0)) + F.coalesce("onward", F.lit(0))).alias("weight"), F.col("loop").alias("dead"), "way"
    )
    solved = _forest(inner.withColumn("frag", _placed(fragment_rows, n, level)), fragment_rows, level + 1)
    # The quotient's top has a chain of its own up to its exit.
    top = quotient.select(F.col("id").alias("root_id"), F.col("exit_id").alias("_exit"), F.col("hops").alias("_hops"))
    solved = solved.join(top, "root_id", "left").select(
        F.col("id").alias("above"), F.col("_exit").alias("_root"), (F.col("depth") + F.col("_hops")).alias("_depth"), F.col("loop").alias("_loop"), F.col("way").alias("_way")
    )
    joined = local.join(materialize(solved), "above", "left")
    led_on = F.col("_loop").isNotNull()
    lost = F.col("loop") | F.coalesce("_loop", F.lit(False))
    return joined.select(
        "id",
        F.when(~lost, F.coalesce("_root", "exit_id")).alias("root_id"),
        F.when(~lost, F.when(led_on, F.col("hops") + F.col("onward") + F.col("_depth")).otherwise(F.col("hops"))).alias("depth"),
        lost.alias("loop"),
        F.when(~lost, F.when(led_on, F.concat("_way", "way")).otherwise(F.col("way"))).alias("way"),
    )


def _solved(df: DataFrame, id: str, parent: str, locality: str | None, order: str | None, fragment_rows: int, paths: bool) -> DataFrame:
    key = F.col(locality).cast("string") if locality else F.col(id).cast("string")
    place = F.coalesce(F.col(order).cast("long"), F.lit(2**62)) if order else F.lit(0).cast("long")
    rows = (
        df.select(F.col(id).cast("string").alias("id"), F.col(parent).cast("string").alias("parent"), F.coalesce(key, F.lit("")).alias("key"), place.alias("place"))
        .where(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.max(F.struct("parent", "key")).alias("r"), F.min("place").alias("place"))
        .select("id", "r.parent", "r.key", "place")
    )
    rows = materialize(rows)
    total = max(1, rows.count())
    # Keys of more than a fragment's rows are cut by a hash of the id. They are written: joined by size, never broadcast unseen.
    sizes = rows.groupBy("key").count().where(F.col("count") > fragment_rows)
    large = materialize(sizes.select("key", F.ceil(F.col("count") / fragment_rows).cast("int").alias("parts")))
    buckets = max(1, math.ceil(4 * total / fragment_rows), min(rows.sparkSession.sparkContext.defaultParallelism, total // 1000 + 1))
    frag = F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("string")).otherwise(
        F.concat_ws("/", "key", F.pmod(F.xxhash64("id"), "parts"))
    )
    way = F.array(F.struct("id", "place")) if paths else F.lit(None).cast(T.ArrayType(_STEP))
    nodes = rows.join(large, "key", "left").select("id", "parent", F.lit(1).cast("long").alias("weight"), F.lit(False).alias("dead"), way.alias("way"), frag.alias("frag"))
    return _forest(nodes, fragment_rows)


def hierarchy(df: DataFrame, id: str = "id", parent: str = "parent_section_id", locality: str | None = None, fragment_rows: int = FRAGMENT_ROWS) -> DataFrame:
    """One row per id: id, root_id, depth, is_cycle.

    A root (parent null or no row's id) has its own id and depth 0. Nodes from which no root can
    be reached have root_id ``cycle``, depth -1 and is_cycle. ``locality`` is a column in which
    most parents and children agree. Rows with a null id are dropped; of rows with the same id
    and different parents the largest parent counts; a row that is its own parent is a cycle.
    Empty input gives no row; other columns are left out.
    """
    out = _solved(df, id, parent, locality, None, fragment_rows, paths=False)
    lost = F.col("loop")
    return out.select("id", F.when(lost, F.lit(CYCLE)).otherwise(F.col("root_id")).alias("root_id"), F.when(lost, F.lit(-1)).otherwise(F.col("depth")).cast("int").alias("depth"), lost.alias("is_cycle"))


def node_paths(
    df: DataFrame, id: str = "id", parent: str = "parent_section_id", order: str | None = "section_order", locality: str | None = None, fragment_rows: int = FRAGMENT_ROWS
) -> DataFrame:
    """id, path (ids from the root down to the node), order_path (sibling positions), depth, root_id.

    Siblings are ordered by ``order``, nulls last (2^62). Nodes of cycles are left out; else the
    rules of :func:`hierarchy`. A path has as many entries as its depth and one more: the rows
    are as large as the result needs.
    """
    out = _solved(df, id, parent, locality, order, fragment_rows, paths=True).where("not loop")
    return out.select("id", F.col("way.id").alias("path"), F.col("way.place").alias("order_path"), F.col("depth").cast("int").alias("depth"), "root_id")


def ancestors(paths: DataFrame) -> DataFrame:
    """All (id, ancestor_id, distance) pairs of :func:`node_paths`, distance 0 being the node itself: the paths unrolled, without a join."""
    return paths.select("id", "depth", F.posexplode("path").alias("k", "ancestor_id")).select("id", "ancestor_id", (F.col("depth") - F.col("k")).alias("distance"))


def hierarchy_paths(
    df: DataFrame, id: str = "id", parent: str = "parent_section_id", order: str = "section_order", locality: str | None = None, fragment_rows: int = FRAGMENT_ROWS
) -> DataFrame:
    """:func:`node_paths` with n_descendants; the descendants of a node are counted before the shuffle."""
    paths = materialize(node_paths(df, id, parent, order, locality, fragment_rows))
    below = paths.select(F.explode(F.slice("path", 1, F.size("path") - 1)).alias("id")).groupBy("id").agg(F.count("*").alias("n_descendants"))
    out = paths.join(below, "id", "left").withColumn("n_descendants", F.coalesce("n_descendants", F.lit(0).cast("long")))
    return out.select("id", "path", "order_path", "depth", "root_id", "n_descendants")
