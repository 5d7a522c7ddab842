"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelmill.llm.tokens import n_tokens
from labelmill.session import materialize

#: Buckets into which a source's documents fall; prefix sums run within buckets and over their totals.
BUCKETS = 4096


def normal_source(source: Column) -> Column:
    """Sources are compared without case and outer blanks."""
    return F.lower(F.regexp_replace(source, r"(?U)^\s+|\s+$", ""))


def _counted(documents: DataFrame, id: str, text: str, source: str) -> DataFrame:
    """id, _s, n_tokens, _t: what the mix needs of a document; the tokens are counted once and written."""
    return materialize(documents.select(F.col(id), normal_source(F.col(source)).alias("_s"), n_tokens(F.col(text)).alias("n_tokens"), F.xxhash64(text).alias("_t")))


def _sizes(counted: DataFrame, targets: DataFrame) -> DataFrame:
    sizes = counted.groupBy("_s").agg(F.sum("n_tokens").alias("size"), F.count("*").alias("n_documents"))
    out = targets.withColumn("_s", normal_source(F.col("source"))).join(sizes, "_s", "left")
    out = out.select(
        "source", "target_share", "max_repeats", F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("n_documents", F.lit(0)).alias("n_documents"), "_s"
    )
    total = Window.partitionBy(F.lit(0))  # one row per target
    return out.withColumn("total", F.sum("size").over(total))


def source_sizes(documents: DataFrame, targets: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """Per target: source, target_share, max_repeats, size and n_documents (0 if none), total.

    ``total`` is the size of all documents whose source is a target. ``targets`` is a small table
    of one row per source (a source's sizes are one row each); documents of other or null sources
    don't count.
    """
    return _sizes(documents.select(normal_source(F.col(source)).alias("_s"), n_tokens(F.col(text)).alias("n_tokens")), targets)


def expected_copies(sizes: DataFrame) -> DataFrame:
    """Adds short (the share can't be reached) and copies, the expected copies of each document.

    A source that falls short is repeated max_repeats times; the rest reach their share of the
    total. A source without documents or with share 0 has 0 copies.
    """
    wanted = F.col("target_share") * F.col("total")
    most = F.col("size") * F.col("max_repeats")
    return sizes.withColumn("short", most < wanted).withColumn(
        "copies", F.when(F.col("size") > 0, F.least(F.col("max_repeats").cast("double"), wanted / F.col("size"))).otherwise(F.lit(0.0))
    )


def _offset(seed: int) -> Column:
    """A uniform offset in [0, 1) per source, fixed by the seed."""
    salt = hashlib.sha256(str(seed).encode()).hexdigest()[:16]
    return F.pmod(F.xxhash64(F.lit(salt), F.col("_s")), F.lit(2**40)) / F.lit(float(2**40))


def mix(documents: DataFrame, targets: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 17) -> DataFrame:
    """The mix, one row per document in it: id, source (as in targets), n_tokens, n_copies.

    Within a source the documents stand in a fixed random order, each as long as its expected
    copies; one random offset is added and a copy is emitted at every integer crossed, so a
    document has the floor or the ceiling of its expected copies, never more than max_repeats.
    Prefix sums are taken within hash buckets and over the buckets' totals, so no source passes
    through one task. Rows with a null id are told apart only by their text; repeated ids count each.
    """
    counted = _counted(documents, id, text, source)
    return _mixed(counted, expected_copies(_sizes(counted, targets)), id, seed)


def mix_report(documents: DataFrame, targets: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 17) -> DataFrame:
    """Per target what the mix came to: the columns of :func:`expected_copies`, reached (size in the mix), n_copies, fitting.

    ``fitting``: every document of the source has the floor or the ceiling of its expected copies
    and their number is within one of what was expected.
    """
    counted = _counted(documents, id, text, source)
    sizes = materialize(expected_copies(_sizes(counted, targets)))
    got = _mixed(counted, sizes, id, seed).groupBy("source").agg(
        F.sum(F.col("n_tokens") * F.col("n_copies")).alias("reached"), F.sum("n_copies").alias("n_copies"),
        F.max("n_copies").alias("_most"), F.min("n_copies").alias("_least"), F.count("*").alias("_n"),
    )
    out = sizes.join(got, "source", "left")
    none = F.col("_n").isNull() | (F.col("_n") < F.col("n_documents"))  # some documents aren't in the mix
    each = (F.coalesce("_most", F.lit(0)) <= F.ceil(F.round("copies", 6))) & (F.when(none, F.lit(0)).otherwise(F.col("_least")) >= F.floor(F.round("copies", 6)))
    n = F.coalesce("n_copies", F.lit(0))
    fitting = each & (F.abs(n - F.col("copies") * F.col("n_documents")) < 1.001)
    return out.select(*sizes.columns, F.coalesce("reached", F.lit(0)).alias("reached"), n.alias("n_copies"), fitting.alias("fitting")).drop("_s")


def _mixed(counted: DataFrame, sizes: DataFrame, id: str, seed: int) -> DataFrame:
    plan = F.broadcast(sizes.select("_s", F.col("source").alias("_given"), "copies"))  # one row per target
    docs = counted
    docs = docs.join(plan, "_s").withColumn("_o", F.xxhash64(id, "_t", F.lit(seed))).withColumn("_b", F.pmod("_o", F.lit(BUCKETS)))
    totals = docs.groupBy("_s", "_b").agg(F.sum("copies").alias("_w"))
    before = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("_w").over(before), F.lit(0.0))).select("_s", "_b", "_before")  # BUCKETS rows a source
    inside = Window.partitionBy("_s", "_b").orderBy("_o", id, "_t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    docs = docs.withColumn("_in", F.row_number().over(inside))
    docs = docs.join(F.broadcast(totals), ["_s", "_b"])
    upto = F.col("_before") + F.col("_in") * F.col("copies") + _offset(seed)
    from_ = F.col("_before") + (F.col("_in") - 1) * F.col("copies") + _offset(seed)
    docs = docs.withColumn("n_copies", (F.floor(F.round(upto, 6)) - F.floor(F.round(from_, 6))).cast("int"))
    return docs.where("n_copies > 0").select(id, F.col("_given").alias("source"), "n_tokens", "n_copies")


def reached_shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target: source, target_share, size in the mix and the share reached (0 of an empty mix)."""
    size = mixed.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("n_copies")).alias("size"))
    out = targets.select("source", "target_share").join(size, "source", "left").withColumn("size", F.coalesce("size", F.lit(0)))
    total = F.sum("size").over(Window.partitionBy(F.lit(0)))  # one row per target
    return out.withColumn("share", F.when(total > 0, F.col("size") / total).otherwise(F.lit(0.0)))
