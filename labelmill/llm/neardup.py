"""Near-duplicate texts by meet-in-the-middle ball hashing.

A text's fingerprints are ``TABLES`` sketches of ``SLOTS`` min-hash values of its word shingles.
Sketches are compared by insertions and removals of slots: a differing slot is a distance of 2.
Two sketches within a radius of 2 meet half-way, at a sketch with one slot removed, so every
fingerprint emits all variants within half the radius (its ``SLOTS`` ways to lose one slot), the
variants are shuffled, and texts that collide in one are verified: first by a 128-bit sketch of
single bits of min-hash values, then by their exact similarity.

Two texts with similarity s agree in a slot with probability s; they collide in a table with
probability s^5 + 5 s^4 (1 - s), in some table with 1 - (1 - that)^TABLES (0.989 at 0.65, 0.998
at 0.7, 1.000 at 0.8). More slots collide less by chance, more tables lose less. The verification is
exact, so all found pairs are right.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelmill.llm.components import components
from labelmill.llm.tokens import word_hashes
from labelmill.session import materialize

#: Words of a shingle and least similarity unless a caller says otherwise.
SHINGLE, THRESHOLD = 5, 0.8
#: Fingerprints per text, slots per fingerprint.
TABLES, SLOTS = 8, 5
#: A sketch's bits differ with probability (1 - s) / 2. Colliding texts are taken to the exact check
#: if the bits that differ are at most this many standard deviations above what the threshold gives.
SKETCH_BITS, SKETCH_DEVIATIONS = 128, 3.0
#: Variants that a task gets on average, and rows of one variant that are compared in one task.
VARIANTS_PER_TASK, BLOCK = 1_000_000, 4_000
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def _shingles(flat: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts and the text of each; texts have ``width`` words at least."""
    n = len(flat)
    text = np.repeat(np.arange(len(lengths)), lengths)
    code = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        code = _mix(code * _M1 + flat[k : n - width + 1 + k])
    inside = text[: n - width + 1] == text[width - 1 :]
    code, text = code[inside], text[: n - width + 1][inside]
    order = np.lexsort((code, text))
    code, text = code[order], text[order]
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
    return code[keep], text[keep]


def _classes(code: np.ndarray, starts: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """A 64-bit id of each text's group and set of shingles, free of order."""
    return _mix(np.add.reduceat(_mix(code ^ _M1), starts) ^ tags)


def _variants(code: np.ndarray, starts: np.ndarray, tables: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """(texts, tables * slots) hashes of the fingerprints with one slot removed, and the sketches (two words)."""
    texts = len(starts)
    out = np.empty((texts, tables * slots), np.uint64)
    sketch = np.zeros((2, texts), np.uint64)
    spread = _mix(code)

    def least(at: int) -> np.ndarray:
        """The texts' min-hash values of one hash function; a bit of them goes to the sketch."""
        seed = np.uint64((2 * at + 1) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF | 1)
        hashed = (spread ^ (seed >> np.uint64(3))) * seed
        hashed ^= hashed >> np.uint64(32)
        hashed *= _M2
        low = _mix(np.minimum.reduceat(hashed, starts) ^ seed)
        if at < SKETCH_BITS:
            sketch[at // 64] |= (low & np.uint64(1)) << np.uint64(at % 64)
        return low

    for t in range(tables):
        values = [least(t * slots + s) for s in range(slots)]
        total = np.add.reduce(values)  # the sum without a slot is that slot's variant
        for s in range(slots):
            out[:, t * slots + s] = _mix((total - values[s]) ^ np.uint64(t * 64 + s + 1))
    for at in range(tables * slots, SKETCH_BITS):
        least(at)
    return out, sketch


def _batch(batch: pa.RecordBatch, width: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the batch with enough words, their groups' tags, their shingles and where each row's begin."""
    lists = batch.column(batch.schema.get_field_index("_w"))
    tags = batch.column(batch.schema.get_field_index("_g")).to_numpy(zero_copy_only=False).view(np.uint64)
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    rows = np.flatnonzero(lengths >= max(least, width))
    if not len(rows):
        return rows, tags[rows], np.empty(0, np.uint64), np.empty(0, np.int64)
    flat = flat[np.repeat(lengths >= max(least, width), lengths)]
    code, text = _shingles(flat, lengths[rows], width)
    return rows, tags[rows], code, np.searchsorted(text, np.arange(len(rows)))


def _hashed(df: DataFrame, text: str, group: list[str], columns: list[str], every: bool = False) -> DataFrame:
    """The columns, a tag of the group and the words' hashes; rows without a text only if ``every`` row is asked for."""
    tag = F.xxhash64(F.lit(0), *group)
    return (df if every else df.where(F.col(text).isNotNull())).select(*columns, tag.alias("_g"), word_hashes(F.col(text)).alias("_w"))


def members(df: DataFrame, id: str, text: str, group: list[str], order: str | None, width: int = SHINGLE, least: int | None = None) -> DataFrame:
    """group, id, cls: the class of texts of a group with the same set of shingles. Texts of fewer than ``least`` words have none.

    Of rows with the same id the one with the largest ``order`` counts; if that has no text or too
    few words, the id has no class.
    """
    least = least or width
    keep = [*group, id, *([order] if order else [])]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("cls", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, tags, code, starts = _batch(batch, width, least)
            cls, short = np.zeros(batch.num_rows, np.int64), np.ones(batch.num_rows, bool)
            if len(rows):
                cls[rows], short[rows] = _classes(code, starts, tags).view(np.int64), False
            yield pa.RecordBatch.from_arrays([*batch.select(keep).columns, pa.array(cls, mask=short)], names=schema.names)

    out = _hashed(df, text, group, keep, every=True).mapInArrow(run, schema)
    # A struct, so that a row without order values keeps its class: nulls come first.
    return out.groupBy(*group, id).agg(F.max(F.struct(*([order] if order else []), "cls"))["cls"].alias("cls")).where("cls is not null")


def _most_bits(threshold: float) -> int:
    """Bits in which sketches of texts of the threshold's similarity may differ."""
    p = (1 - threshold) / 2
    return math.ceil(SKETCH_BITS * p + SKETCH_DEVIATIONS * math.sqrt(SKETCH_BITS * p * (1 - p)))


def _candidates(df: DataFrame, group: list[str], text: str, width: int, threshold: float, least: int, tables: int, slots: int) -> DataFrame:
    """Pairs of classes, x < y, that collide in a variant."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("cls", "s0", "s1", "v")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, tags, code, starts = _batch(batch, width, least)
            if not len(rows):
                continue
            cls = _classes(code, starts, tags)
            # Copies within a batch emit once, so a class that holds a third of all rows stays small.
            _, first = np.unique(cls, return_index=True)
            v, sketch = _variants(code, starts, tables, slots)
            v, sketch = v[first], sketch[:, first]
            # Groups meet in variants of their own.
            v = _mix(v ^ tags[first][:, None])
            arrays = [*[np.repeat(x, v.shape[1]) for x in (cls[first], *sketch)], v.reshape(-1)]
            whole = pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in arrays], names=schema.names)
            for k in range(0, whole.num_rows, 50_000):
                yield whole.slice(k, 50_000)

    emitted = _hashed(df, text, group, []).mapInArrow(run, schema)
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() * tables * slots // VARIANTS_PER_TASK))
    # One pass over the shuffled variants keeps those that unlike classes share; a class of many copies alone is none.
    same = Window.partitionBy("v")
    sized = emitted.repartition(n, "v").select("*", *[f("cls").over(same).alias(c) for f, c in ((F.count, "k"), (F.min, "lo"), (F.max, "hi"))])
    return _meet(materialize(sized.where("lo < hi").drop("lo", "hi").distinct()), threshold)


def _meet(variants: DataFrame, threshold: float, block: int | None = None) -> DataFrame:
    """Pairs of classes, x < y, of one variant whose sketches are near enough.

    ``variants`` has cls, s0, s1, v and k, the variant's rows at most. A variant of more than
    ``block`` (``BLOCK``) rows is cut into blocks by a hash of the class; each two blocks, and each
    block with itself, meet under a key of their own, so no task gets all pairs and none is lost.
    """
    blocks = F.ceil(F.col("k") / F.lit(block or BLOCK)).cast("int")
    mine = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(F.least(i, "mine").alias("p"), F.greatest(i, "mine").alias("q")))
    placed = variants.withColumn("blocks", blocks).withColumn("mine", mine).select("cls", "s0", "s1", "v", "mine", F.inline(cells))
    a, b = placed.alias("a"), placed.alias("b")
    on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("v", "p", "q")] + [F.col("a.cls") < F.col("b.cls")]
    on.append((F.col("a.mine") != F.col("b.mine")) | (F.col("a.p") == F.col("a.q")))
    differing = sum((F.bit_count(F.col(f"a.{c}").bitwiseXOR(F.col(f"b.{c}"))) for c in ("s0", "s1")), F.lit(0))
    on.append(differing <= _most_bits(threshold))
    return a.join(b, on).select(F.col("a.cls").alias("x"), F.col("b.cls").alias("y")).distinct()


def _sets(df: DataFrame, group: list[str], text: str, width: int, least: int) -> DataFrame:
    """cls, shingles: each class's sorted set of shingle hashes (32 bits), once per batch."""
    schema = T.StructType([T.StructField("cls", T.LongType()), T.StructField("shingles", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, tags, code, starts = _batch(batch, width, least)
            if not len(rows):
                continue
            cls = _classes(code, starts, tags)
            _, first = np.unique(cls, return_index=True)
            lists = pa.ListArray.from_arrays(np.append(starts, len(code)).astype(np.int32), (code >> np.uint64(32)).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(cls[first].view(np.int64)), lists.take(pa.array(first))], names=schema.names)

    return _hashed(df, text, group, []).mapInArrow(run, schema)


def similar_classes(
    df: DataFrame, text: str, group: list[str] | None = None, width: int = SHINGLE, threshold: float = THRESHOLD, least: int | None = None,
    tables: int = TABLES, slots: int = SLOTS,
) -> DataFrame:
    """Pairs (x, y, similarity) of classes of texts with at least ``threshold`` similarity, x < y.

    Similarity is that of the sets of ``width``-word shingles (words: runs of letters and digits,
    case ignored): common ones by all. Only texts of one group are compared. Texts that are
    null, empty or shorter than ``least`` words have no class; equal sets are one class, so copies
    make no pairs here.
    """
    group, least = group or [], least or width
    pairs = materialize(_candidates(df, group, text, width, threshold, least, tables, slots))
    involved = pairs.select(F.explode(F.array("x", "y")).alias("cls")).distinct()
    sets = _sets(df, group, text, width, least).join(involved, "cls", "left_semi").groupBy("cls").agg(F.first("shingles").alias("shingles"))
    sets = materialize(sets)
    left = pairs.join(sets.select(F.col("cls").alias("x"), F.col("shingles").alias("a")), "x")
    both = left.join(sets.select(F.col("cls").alias("y"), F.col("shingles").alias("b")), "y")
    common = F.size(F.array_intersect("a", "b"))
    similarity = common / (F.size("a") + F.size("b") - common)
    return both.select("x", "y", similarity.alias("similarity")).where(F.col("similarity") >= threshold)


def similar_pairs(
    df: DataFrame, id: str, text: str, group: list[str] | None = None, order: str | None = None, width: int = SHINGLE, threshold: float = THRESHOLD,
    least: int | None = None,
) -> DataFrame:
    """All pairs (group, id_a, id_b) of rows of a group with different ids, id_a < id_b, copies included."""
    group = group or []
    # The classes of rows that a later delivery replaced can only add candidates; the members decide.
    who = materialize(members(df, id, text, group, order, width, least))
    pairs = materialize(similar_classes(df, text, group, width, threshold, least).select("x", "y"))
    a = who.select(*group, F.col("cls").alias("x"), F.col(id).alias("i"))
    b = who.select(F.col("cls").alias("y"), F.col(id).alias("j"))
    different = pairs.join(a, "x").join(b, "y").select(*group, "i", "j")
    many = who.groupBy("cls").count().where("count > 1").select("cls")
    copies = who.join(many, "cls", "left_semi")
    c, d = copies.alias("c"), copies.alias("d")
    same = c.join(d, [F.col("c.cls") == F.col("d.cls"), F.col(f"c.{id}") < F.col(f"d.{id}")])
    same = same.select(*[F.col(f"c.{g}").alias(g) for g in group], F.col(f"c.{id}").alias("i"), F.col(f"d.{id}").alias("j"))
    out = different.unionByName(same)
    return out.select(*group, F.least("i", "j").alias("id_a"), F.greatest("i", "j").alias("id_b"))


def duplicate_groups(
    df: DataFrame, id: str, text: str, group: list[str] | None = None, order: str | None = None, width: int = SHINGLE, threshold: float = THRESHOLD,
    least: int | None = None,
) -> DataFrame:
    """One row per id with a class: group, id, cls, n_links (similar other classes), cluster.

    ``cluster`` is the smallest class reachable over links.
    """
    group = group or []
    who = members(df, id, text, group, order, width, least)
    pairs = materialize(similar_classes(df, text, group, width, threshold, least).select("x", "y"))
    links = pairs.select(F.explode(F.array("x", "y")).alias("cls")).groupBy("cls").agg(F.count("*").alias("n_links"))
    label = components(pairs, "x", "y").select(F.col("node").alias("cls"), F.col("component").alias("cluster"))
    out = who.join(links, "cls", "left").join(label, "cls", "left")
    return out.select(*group, id, "cls", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("cluster", "cls").alias("cluster"))
