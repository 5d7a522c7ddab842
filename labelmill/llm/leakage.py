"""Evaluation texts leaking into a corpus: SimHash windows, multi-index Hamming blocks, exact check.

A leaked passage may be no more than a part of its item and may itself be changed, so an item is
looked for at several sizes. Windows as long as a part of the item (``WINDOWS``: the sizes up to
half of its words) get a 64-bit SimHash of their words; the bits are cut into radius + 1 blocks,
windows within the radius agree in a block entirely, so the block tables find them all. A changed
word of a short window flips more bits than any radius with selective blocks allows, so unchanged
runs of ``RUN`` words are looked up as well: a document is a candidate if it has about a quarter of
those that half of the item still has when every fifth word is changed. Candidates are verified by
the weighted shingles they share with the item in order, in at most two stretches; a shingle weighs
less the more documents hold it. The documents that hold it within a passage of the item count by
how many different passages they are, so copies of a leak don't weaken it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b
from itertools import islice, zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from labelmill.llm.tokens import word_hashes
from labelmill.session import materialize

#: Words of a window -> (Hamming radius of a collision, words between a document's windows). All of an item's windows are looked up.
WINDOWS = {8: (3, 1), 32: (4, 8)}
#: Words of an unchanged run; items of fewer than ``SHORT`` words are looked up by runs of a shingle's words.
RUN, SHORT = 4, 24
#: Words of the item for each run that a candidate needs (it needs one at least).
WORDS_PER_RUN = 40
#: Words of a verified shingle; share of an item's shingle weight that makes a leak: half of the words,
#: less the shingles that a few changed words break.
SHINGLE, SHARE = 3, 0.4
#: Share of an item's shingles, in any order and unweighted, below which a text can't hold half of its words with few changes.
LEAST = 0.2
#: Words between two shared shingles that end a stretch.
GAP = 12
#: Words on either side of a shingle, within its stretch, that tell passages apart.
AROUND = 6
#: Items a task holds at once; more items are taken in turns over the tokenised corpus, which is written once.
ITEMS_AT_ONCE = 10_000
_MARKUP = r"<[^<>]*>|&[a-z]+;|&#\d+;"
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def clean(text):
    """Text without mark-up and entities."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _MARKUP, " ")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M2
    return x ^ (x >> np.uint64(29))


def _plus(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    """Sums of counts of 64 bits each, as planes: plane k holds the counts' binary digits k."""
    out, carry = [], None
    for x, y in zip_longest(a, b):
        digits = [v for v in (x, y, carry) if v is not None]
        if len(digits) == 1:
            out.append(digits[0])
            carry = None
            continue
        both, one = digits[0] & digits[1], digits[0] ^ digits[1]
        if len(digits) == 3:
            both |= one & digits[2]
            one ^= digits[2]
        out.append(one)
        carry = both
    return out if carry is None else [*out, carry]


def simhashes(words: np.ndarray, width: int, stride: int = 1) -> np.ndarray:
    """SimHash of the runs of ``width`` words at every ``stride``-th place: the majority of each bit over the words' hashes.

    The 64 counts of a run are added at once, by planes: those of a run from those of its halves.
    """
    if len(words) < width:
        return np.empty(0, np.uint64)
    n = len(words) - width + 1
    counts: list[np.ndarray] = []
    power, size, begin = [words], 1, 0  # counts of the runs of ``size`` words, words of the run counted so far
    while True:
        if width & size:
            counts = _plus(counts, [p[begin : begin + n] for p in power])
            begin += size
        if begin == width:
            break
        power = _plus([p[:-size] for p in power], [p[size:] for p in power])
        size *= 2
    above, equal = np.zeros(n, np.uint64), np.full(n, ~np.uint64(0))
    for k in reversed(range(max(len(counts), (width // 2).bit_length()))):
        digit = counts[k] if k < len(counts) else np.zeros(n, np.uint64)
        if width // 2 >> k & 1:
            equal &= digit
        else:
            above |= equal & digit
            equal &= ~digit
    return above[::stride]


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    if len(words) < width:
        return np.empty(0, np.uint64)
    n = len(words) - width + 1
    code = np.zeros(n, np.uint64)
    for k in range(width):
        code = _mix(code * _M1 + words[k : n + k])
    return code


def _print(words: np.ndarray) -> int:
    return int.from_bytes(blake2b(words.tobytes(), digest_size=8).digest(), "little", signed=True)


class Blocks:
    """The items' windows of one width in block tables."""

    def __init__(self, items: list[np.ndarray], width: int, radius: int, stride: int):
        self.width, self.radius, self.stride = width, radius, stride
        self.bits = np.uint64(64 // (radius + 1))
        prints = [np.unique(simhashes(words, width)) if len(words) >= 2 * width else np.empty(0, np.uint64) for words in items]
        self.prints = np.concatenate([*prints, np.empty(0, np.uint64)])
        self.owner = np.repeat(np.arange(len(items)), [len(h) for h in prints])
        self.tables = []
        for b in range(radius + 1):
            part = self._block(self.prints, b)
            size = np.bincount(part, minlength=1 << int(self.bits))
            self.tables.append((np.argsort(part, kind="stable"), np.concatenate([[0], np.cumsum(size)]), size > 0))

    def _block(self, h: np.ndarray, b: int) -> np.ndarray:
        return ((h >> (np.uint64(b) * self.bits)) & np.uint64((1 << int(self.bits)) - 1)).astype(np.int64)

    def collisions(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word of the window, item) of all windows within the radius of one of the items'."""
        h = simhashes(words, self.width, self.stride)
        at, items = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for b, (order, first, there) in enumerate(self.tables):
            part = self._block(h, b)
            hit = np.flatnonzero(there[part])
            n = first[part[hit] + 1] - first[part[hit]]
            where = np.repeat(hit, n)
            offset = np.arange(len(where)) - np.repeat(np.cumsum(n) - n, n)
            entry = order[np.repeat(first[part[hit]], n) + offset]
            near = np.bitwise_count(self.prints[entry] ^ h[where]) <= self.radius
            at.append(where[near] * self.stride)
            items.append(self.owner[entry[near]])
        return np.concatenate(at), np.concatenate(items)


class Index:
    """All that documents are looked up in: the items' windows, runs and shingles."""

    def __init__(self, items: list[np.ndarray]):
        self.windows = [Blocks(items, w, r, stride) for w, (r, stride) in WINDOWS.items()]
        self.shingles = [shingles(w, SHINGLE) for w in items]
        self.known = np.unique(np.concatenate([*self.shingles, np.empty(0, np.uint64)]))
        codes = [np.unique(x) for x in self.shingles]
        self.distinct = np.array([len(x) for x in codes], np.int64)
        place = np.searchsorted(self.known, np.concatenate([*codes, np.empty(0, np.uint64)]))
        order = np.argsort(place, kind="stable")
        self.holder = np.repeat(np.arange(len(items)), self.distinct)[order]
        self.holder_at = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(self.known)))])
        # Runs by their hash, with the items that have them.
        run = [SHINGLE if len(w) < SHORT else RUN for w in items]
        self.needed = np.array([max(1, len(w) // WORDS_PER_RUN) for w in items], np.int64)
        self.runs = {}
        for size in sorted(set(run)):
            codes = [np.unique(shingles(w, size)) if r == size else np.empty(0, np.uint64) for w, r in zip(items, run, strict=True)]
            owner = np.repeat(np.arange(len(items)), [len(c) for c in codes])
            codes = np.concatenate(codes)
            order = np.argsort(codes, kind="stable")
            self.runs[size] = (codes[order], owner[order])

    def enough(self, held: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """The (text, item) pairs of which the text has ``LEAST`` of the item's shingles; ``held``: distinct (text, known shingle)."""
        n = self.holder_at[held[1] + 1] - self.holder_at[held[1]]
        entry = np.repeat(self.holder_at[held[1]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        key, count = np.unique(np.repeat(held[0], n) * len(self.distinct) + self.holder[entry], return_counts=True)
        key = key[count >= LEAST * self.distinct[key % len(self.distinct)]]
        return pairs[:, np.isin(pairs[0] * len(self.distinct) + pairs[1], key)]

    def candidates(self, words: np.ndarray, text_of: np.ndarray) -> np.ndarray:
        """Sorted distinct (text, item) pairs; ``text_of`` is the text of each word."""
        pairs = []
        for blocks in self.windows:
            step = 100_000 // blocks.stride * blocks.stride
            for begin in range(0, len(words), step):  # bounds the memory of the bit sums
                at, item = blocks.collisions(words[begin : begin + step + blocks.width - 1])
                at = at + begin
                whole = text_of[at] == text_of[at + blocks.width - 1]
                pairs.append(np.stack([text_of[at[whole]], item[whole]]))
        for size, (known, owner) in self.runs.items():
            codes = shingles(words, size)
            if not len(codes) or not len(known):
                continue
            lo = np.searchsorted(known, codes)
            hit = np.flatnonzero((known[np.minimum(lo, len(known) - 1)] == codes) & (text_of[: len(codes)] == text_of[size - 1 :]))
            # A run counts once a text.
            seen, place = np.unique(np.stack([text_of[hit], lo[hit]]), axis=1)
            n = np.searchsorted(known, known[place], side="right") - place
            text, entry = np.repeat(seen, n), np.repeat(place, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            found, count = np.unique(np.stack([text, owner[entry]]), axis=1, return_counts=True)
            pairs.append(found[:, count >= self.needed[found[1]]])
        return np.unique(np.concatenate([*pairs, np.empty((2, 0), np.int64)], axis=1).astype(np.int64), axis=1)


def shared_in_order(document: np.ndarray, item: np.ndarray, gap: int = GAP) -> np.ndarray:
    """Positions of the item's shingles that the document holds in at most two stretches.

    A stretch is a run of shared shingles with at most ``gap`` words between neighbours, whose
    places in the item rise; a place that falls or leaps by more than ``gap`` begins another.
    """
    return np.array(sorted(_held(document, item, gap)), np.int64)


def _held(document: np.ndarray, item: np.ndarray, gap: int = GAP) -> dict[int, tuple[int, int, int]]:
    """Per position of :func:`shared_in_order` its place in the document and the first and last place of its stretch."""
    order = np.argsort(item, kind="stable")
    ranked = item[order]
    lo = np.searchsorted(ranked, document)
    lo[lo == len(ranked)] = 0
    at = np.flatnonzero(ranked[lo] == document)
    if not len(at):
        return {}
    chains: list[dict[int, int]] = []  # places in the item, in order, and in the document
    ends: list[tuple[int, int]] = []  # last place in the document and in the item
    open_: list[int] = []  # chains whose end is near enough to go on
    for d in at.tolist():
        k = int(lo[d])
        code = document[d]
        options = []
        while k < len(ranked) and ranked[k] == code:
            options.append(int(order[k]))
            k += 1
        open_ = [c for c in open_ if d - ends[c][0] <= gap + 1]
        best = None
        for c in reversed(open_):
            for i in options:
                if 0 < i - ends[c][1] <= gap + 1 and d > ends[c][0]:
                    cost = abs((i - ends[c][1]) - (d - ends[c][0]))
                    if best is None or cost < best[0]:
                        best = (cost, c, i)
        if best:
            chains[best[1]][best[2]] = d
            ends[best[1]] = (d, best[2])
        for i in [] if best else options:  # any of the places may be where the stretch begins
            open_.append(len(chains))
            chains.append({i: d})
            ends.append((d, i))
    chains.sort(key=len, reverse=True)
    # A place of the document counts once, also where the item repeats itself.
    first, used = chains[0], set(chains[0].values())
    own = [{i: d for i, d in c.items() if i not in first and d not in used} for c in chains[1:]]
    second = max(own, key=len, default={})
    out = {}
    for chain in (second, first):
        begin, end = min(chain.values(), default=0), max(chain.values(), default=0)
        out |= {i: (d, begin, end) for i, d in chain.items()}
    return out


def leaks(documents: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", share: float = SHARE) -> DataFrame:
    """(item_id, id, similarity) of all documents that hold at least ``share`` of an item.

    ``similarity`` is the weight of the item's shingles found, by the weight of all. Case,
    punctuation, mark-up and spacing don't matter. Null and empty texts hold nothing; an item of
    fewer than three words is never found. Repeated documents are found each. Items beyond
    ``ITEMS_AT_ONCE`` are taken in turns; the corpus is read and tokenised once for all of them.
    """
    kinds = (documents.schema[id].dataType, items.schema[item_id].dataType)
    ready = items.where(F.col(item_id).isNotNull()).select(item_id, word_hashes(clean(F.col(item_text))).alias("w")).where(F.size("w") >= SHINGLE)
    ready = materialize(ready)
    many = ready.count() > ITEMS_AT_ONCE
    corpus = documents.select(id, word_hashes(clean(F.col(text))).alias("w"))
    corpus = materialize(corpus) if many else corpus
    found = []
    rows = (ready.orderBy(item_id) if many else ready).toLocalIterator()  # never more than one turn's items on the driver
    while part := [(r[item_id], np.array(r["w"], np.int64).view(np.uint64)) for r in islice(rows, ITEMS_AT_ONCE)]:
        found.append(_turn(corpus, part, id, item_id, kinds, share))
    return reduce(DataFrame.unionByName, found or [_turn(corpus, [], id, item_id, kinds, share)])


def _turn(corpus: DataFrame, items: list, id: str, item_id: str, kinds: tuple, share: float) -> DataFrame:
    spark = corpus.sparkSession
    id_type = to_arrow_type(kinds[0])
    held = spark.sparkContext.broadcast([w for _, w in items])
    schema = T.StructType(
        [
            T.StructField(id, kinds[0]),
            T.StructField("item", T.IntegerType()),
            T.StructField("places", T.ArrayType(T.IntegerType())),
            T.StructField("around", T.ArrayType(T.LongType())),
            T.StructField("code", T.LongType()),
            T.StructField("n", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(held.value)
        holders = np.zeros(len(index.known), np.int64)
        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy()
            flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            offsets = offsets - offsets[0]
            places, around = [], []
            # Shingles and windows of the whole batch at once; those across two documents are dropped.
            text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            codes = shingles(flat, SHINGLE)
            if len(codes) and len(index.known):
                spot = np.minimum(np.searchsorted(index.known, codes), len(index.known) - 1)
                known = (index.known[spot] == codes) & (text_of[: len(codes)] == text_of[SHINGLE - 1 :])
                pairs = np.unique(np.stack([text_of[: len(codes)][known], spot[known]]), axis=1)
                holders += np.bincount(pairs[1], minlength=len(holders))
            met = index.candidates(flat, text_of)
            docs, who = (index.enough(pairs, met) if met.size else met).tolist()
            done = list(zip(docs, who, strict=True))
            for d, i in done:
                words = flat[offsets[d] : offsets[d + 1]]
                held_at = sorted(_held(shingles(words, SHINGLE), index.shingles[i]).items())
                places.append([p for p, _ in held_at])
                around.append([_print(words[max(a, d - AROUND) : min(z, d + AROUND) + SHINGLE]) for _, (d, a, z) in held_at])
            none = [None] * len(docs)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(docs, pa.int64())), pa.array(who, pa.int32()), pa.array(places, pa.list_(pa.int32())),
                    pa.array(around, pa.list_(pa.int64())), pa.array(none, pa.int64()), pa.array(none, pa.int64()),
                ],
                names=schema.names,
            )
        seen = np.flatnonzero(holders)
        none = [None] * len(seen)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(none, id_type), pa.array(none, pa.int32()),
                pa.array(none, pa.list_(pa.int32())), pa.array(none, pa.list_(pa.int64())), pa.array(index.known[seen].view(np.int64)), pa.array(holders[seen]),
            ],
            names=schema.names,
        )

    met = materialize(corpus.mapInArrow(run, schema))
    # How many documents hold each shingle of the items: as many rows as the items of a turn have shingles.
    holders = {r.code: r.n for r in met.where("code is not null").groupBy("code").agg(F.sum("n").alias("n")).toLocalIterator()}
    # Of the documents that hold a place within a passage of the item: how many, and how many different passages they
    # are, by size ((sum n)^2 / sum n^2): copies are one, and so are near-copies as long as few change the same words.
    pairs = met.where("item is not null").select("item", F.inline(F.arrays_zip("places", "around")))
    kinds_of = pairs.groupBy("item", "places", "around").agg(F.count("*").cast("double").alias("n"))
    kinds_of = kinds_of.groupBy("item", "places").agg(F.sum("n").alias("n"), (F.sum("n") ** 2 / F.sum(F.col("n") ** 2)).alias("passages"))
    inside = {(r.item, r.places): (r.n, r.passages) for r in kinds_of.toLocalIterator()}  # a row per place of the items at most
    rows = []
    for k, (i, w) in enumerate(items):
        weights = []
        for place, c in enumerate(shingles(w, SHINGLE).view(np.int64)):
            n, passages = inside.get((k, place), (0, 0))
            # What one passage holds weighs as much as what none does: a single leak of half an item has half its weight.
            weights.append(1 / np.log2(2 + max(0, max(0, holders.get(int(c), 0) - n) + passages - 1)))
        rows.append((k, i, [float(x) for x in weights], float(sum(weights))))
    weighed = spark.createDataFrame(
        rows, T.StructType([T.StructField("item", T.IntegerType()), T.StructField(item_id, kinds[1]), T.StructField("weights", T.ArrayType(T.DoubleType())), T.StructField("total", T.DoubleType())])
    )
    held_weight = F.aggregate("places", F.lit(0.0), lambda acc, p: acc + F.get("weights", p))
    scored = met.where("item is not null").join(F.broadcast(weighed), "item")  # ITEMS_AT_ONCE rows at most
    return scored.select(item_id, id, (held_weight / F.col("total")).alias("similarity")).where(F.col("similarity") >= share)
