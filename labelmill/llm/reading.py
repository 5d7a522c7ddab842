"""Reading level: how large a frequency-ranked vocabulary covers a text, and how long its sentences are.

The words of the whole corpus are ranked by frequency. A text's coverage rank is the size of the
smallest such vocabulary that covers a fixed share of its tokens. Coverage rank and sentence
length are calibrated in SQL against texts whose level is known. Sentence complexity has two parts, words per sentence and letters
per word: texts without sentence signs (lists, capitals, tables) still have the second.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from labelmill.llm.tokens import words
from labelmill.session import materialize

#: Share of a text's word tokens that the vocabulary must cover.
SHARE = 0.5
#: Words that every task holds. Texts whose coverage needs a rarer word are ranked against the whole vocabulary by a join.
RANKS = 65_536
#: Texts of fewer words have no level.
MIN_WORDS = 20
_SENTENCE = r"[.!?]+(?:\s|$)|[\n;•·‣◦]+"
_MARKUP = r"<[^<>]*>"


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """word, n of all texts, mark-up left out. Words without a letter are left out too: numbers are not vocabulary."""
    plain = F.regexp_replace(F.col(text), _MARKUP, "\n")
    return df.select(F.explode(words(plain)).alias("word")).where(F.col("word").rlike(r"\p{L}")).groupBy("word").agg(F.count("*").alias("n"))


def vocabulary(df: DataFrame, text: str, ranks: int = RANKS) -> DataFrame:
    """word, n, rank of the ``ranks`` most frequent words of all texts; ties by word."""
    return _top(word_counts(df, text), ranks)


def _top(counts: DataFrame, ranks: int) -> DataFrame:
    """A top-k, so it is taken from sorted partitions without a sort of the whole vocabulary."""
    top = counts.orderBy(F.desc("n"), "word").limit(ranks)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "word")))  # at most ``ranks`` rows


def _rare_ranks(counts: DataFrame) -> DataFrame:
    """n, rank: how many words are at least as frequent; words of one frequency enter a vocabulary together.

    One row per frequency that occurs; they are summed up over the square root of their number of
    blocks, so no task sees more than a block.
    """
    sizes = counts.groupBy("n").agg(F.count("*").alias("words")).withColumn("block", F.floor(F.log2(F.col("n").cast("double")) * 64))
    within = F.sum("words").over(Window.partitionBy("block").orderBy(F.desc("n")))
    above = F.coalesce(F.sum("block_words").over(Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = sizes.groupBy("block").agg(F.sum("words").alias("block_words")).select("block", above.alias("above"))  # 64 rows per doubling of n
    return sizes.withColumn("within", within).join(blocks, "block").select("n", (F.col("above") + F.col("within")).alias("rank"))


def rare_coverage(df: DataFrame, id: list[str], text: str, counts: DataFrame, share: float = SHARE) -> DataFrame:
    """id, coverage_rank of texts against the whole vocabulary, by joins: exact whatever its size. Ids are distinct.

    A text's words are counted before they meet the vocabulary; a text's row of frequencies is as
    long as the text at most.
    """
    plain = F.regexp_replace(F.col(text), _MARKUP, "\n")
    tokens = df.select(*id, F.explode(words(plain)).alias("word")).where(F.col("word").rlike(r"\p{L}")).groupBy(*id, "word").agg(F.count("*").alias("times"))
    known = tokens.join(counts, "word").join(_rare_ranks(counts), "n")
    sums = known.groupBy(*id, "rank").agg(F.sum("times").alias("times"))
    w = Window.partitionBy(*id)
    upto = sums.withColumn("upto", F.sum("times").over(w.orderBy("rank"))).withColumn("all", F.sum("times").over(w))
    return upto.where(F.col("upto") >= F.ceil(F.col("all") * share)).groupBy(*id).agg(F.min("rank").cast("int").alias("coverage_rank"))


def text_measures(df: DataFrame, text: str, vocab: dict[str, int], share: float = SHARE, ranks: int = RANKS) -> DataFrame:
    """Adds n_words, words_per_sentence, letters_per_word, coverage_rank to ``df`` and drops ``text``.

    Null and empty texts have 0 words and null measures.
    """
    spark = df.sparkSession
    held = spark.sparkContext.broadcast(vocab)  # at most ``ranks`` words
    word, sentence = re.compile(r"[^\W_]+"), re.compile(_SENTENCE)
    markup = re.compile(_MARKUP)
    letter = re.compile(r"[^\W\d_]")
    names = [c for c in df.columns if c != text]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = held.value
        for batch in batches:
            n_words, per_sentence, letters, coverage = [], [], [], []
            for t in batch.column(batch.schema.get_field_index(text)).to_pylist():
                n_words.append(len(word.findall(t)) if t else 0)  # mark-up counts for the length only
                if t and "<" in t:
                    t = markup.sub("\n", t)
                tokens = word.findall(t.lower()) if t else []
                if not tokens:
                    per_sentence.append(None)
                    letters.append(None)
                    coverage.append(None)
                    continue
                letters.append(sum(map(len, tokens)) / len(tokens))
                got = []
                for w in tokens:
                    r = rank.get(w)
                    if r is None:
                        r = ranks + 1 if letter.search(w) else 0
                    if r:
                        got.append(r)
                sentences = sum(1 for s in sentence.split(t) if s and not s.isspace())
                per_sentence.append(len(tokens) / max(1, sentences))
                got.sort()
                coverage.append(got[min(len(got) - 1, int(np.ceil(share * len(got))) - 1)] if got else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in names]
                + [pa.array(n_words, pa.int32()), pa.array(per_sentence, pa.float64()), pa.array(letters, pa.float64()), pa.array(coverage, pa.int32())],
                names=[*names, "n_words", "words_per_sentence", "letters_per_word", "coverage_rank"],
            )

    schema = T.StructType([f for f in df.schema if f.name != text])
    schema = schema.add("n_words", "integer").add("words_per_sentence", "double").add("letters_per_word", "double").add("coverage_rank", "integer")
    return df.mapInArrow(measure, schema)


#: What a band is calibrated on: measure -> SQL, its least spread.
MEASURES = {
    "r": ("ln(coverage_rank)", 0.2),
    "s": ("ln(greatest(words_per_sentence, 1.0))", 0.3),
    "l": ("letters_per_word", 0.2),
}
#: A measure's distance from a band counts squared up to this many spreads and linearly beyond, so
#: that one odd measure can't decide.
MOST_SPREADS = 3.0


def calibrate(anchors: DataFrame, band: str = "band") -> DataFrame:
    """Per band the mean and the spread of each measure (one row a band)."""
    rated = anchors.where("coverage_rank is not null").select(band, *[F.expr(q).alias(m) for m, (q, _) in MEASURES.items()])
    return rated.groupBy(band).agg(
        *[F.avg(m).alias(f"{m}_mean") for m in MEASURES],
        *[F.greatest(F.coalesce(F.stddev_pop(m), F.lit(0.0)), F.lit(least)).alias(f"{m}_dev") for m, (_, least) in MEASURES.items()],
    )


def reading_levels(df: DataFrame, id: list[str], text: str, anchors: DataFrame, anchor_text: str = "text", band: str = "band") -> DataFrame:
    """Per row of ``df``: the ids, n_words, words_per_sentence, letters_per_word, coverage_rank, band.

    The band is that of ``anchors`` whose measures are nearest (in units of the bands' mean
    spread). Texts of fewer than 20 words, null and empty ones have a null band. Repeated rows
    are rated each. ``anchors`` is a small table of rated texts; its bands are the classes.
    """
    counts = materialize(word_counts(df, text))
    vocab = {r.word: r.rank for r in _top(counts, RANKS).toLocalIterator()}  # RANKS rows at most
    rated = calibrate(text_measures(anchors.select(band, F.col(anchor_text).alias(text)), text, vocab), band).collect()  # one row a band
    texts = df.select(*id, text)
    measured = text_measures(texts, text, vocab)
    if len(vocab) == RANKS:  # only then may a text need a rarer word
        measured = materialize(measured.withColumn("_row", F.monotonically_increasing_id()))
        rare = measured.where(F.col("coverage_rank") > RANKS).select(*id).distinct()
        exact = materialize(rare_coverage(texts.join(rare, id, "left_semi").dropDuplicates(id), id, text, counts).withColumnRenamed("coverage_rank", "_exact"))
        measured = measured.join(exact, id, "left").withColumn("coverage_rank", F.when(F.col("coverage_rank") > RANKS, F.coalesce("_exact", "coverage_rank")).otherwise(F.col("coverage_rank"))).drop("_exact", "_row")
    nearest = F.lit(None).cast("string")
    if rated:
        distance = []
        for x in rated:
            parts = []
            for m, (q, _) in MEASURES.items():
                dev = sum(y[f"{m}_dev"] for y in rated) / len(rated)
                z = f"abs({q} - {x[f'{m}_mean']!r}D) / {dev!r}D"
                parts.append(f"least({z}, {MOST_SPREADS}D) * (2 * {z} - least({z}, {MOST_SPREADS}D))")
            distance.append(F.struct(F.expr(" + ".join(parts)).alias("d"), F.lit(x[band]).alias("band")))
        nearest = (F.least(*distance) if len(distance) > 1 else distance[0])["band"]
    return measured.withColumn(band, F.when((F.col("n_words") >= MIN_WORDS) & F.col("coverage_rank").isNotNull(), nearest))
