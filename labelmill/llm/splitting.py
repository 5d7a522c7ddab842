"""Cutting oversized texts at natural boundaries by structure-tree packing.

A text is parsed into a tree: sections under headings of each rank, elements by their nesting,
paragraphs, lines and list items by their indentation, sentences, clauses, tokens. Bottom-up,
sibling subtrees are merged as long as they fit; only a node that is too large itself is descended
into, so a node that fits is never cut and nothing is merged across its parent's border.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from labelmill.llm.tokens import TOKEN_PY, n_tokens

LIMIT, OVERLAP = 800, 80
_TOKEN = re.compile(TOKEN_PY)
# A boundary's level: a kind and a depth within it; the smallest levels are nearest the root.
_HEADED, _NESTED, _LINED, _SENTENCE, _CLAUSE = range(5)
_HEADINGS = re.compile(r"(?im)^[ \t]*(?:(#{1,6})[ \t]|(?=<h([1-6])\b))|<h([1-6])\b")
_TITLES = re.compile(r"(?m)^(?=[A-Z][A-Z0-9 ,&/()-]{3,78}[ \t]*:?$)|^(?=[^\n.!?|<]{3,78}: [^\n.!?|<]{0,40}$)")
_TAGS = re.compile(r"(?i)<(/?)(div|section|article|header|footer|main|aside|table|thead|tbody|tr|td|th|ul|ol|li|dl|dt|dd|p|blockquote|pre|br|hr)\b[^<>]*>\s*")
_PARAGRAPHS = re.compile(r"\n[ \t]*\n\s*")
_LINES = re.compile(r"\n([ \t]*)(?=\S)")
_SENTENCES = re.compile(r"(?<=[.!?…。！？])[\"')\]]*\s+|(?<=[。！？])")
_CLAUSES = re.compile(r"(?<=[;:,])\s+")
#: Nesting and indentation are told apart down to this depth; what is deeper counts as this deep.
DEEPEST = 100


def boundaries(text: str) -> list[tuple[int, tuple[int, int]]]:
    """(place, level) of all boundaries of the structure tree, by place; a node begins at its boundary."""
    found: dict[int, tuple[int, int]] = {}

    def put(place: int, kind: int, depth: int = 0) -> None:
        level = (kind, min(depth, DEEPEST))
        if place not in found or level < found[place]:
            found[place] = level

    for m in _HEADINGS.finditer(text):
        put(m.start(), _HEADED, len(m.group(1)) if m.group(1) else int(m.group(2) or m.group(3)))
    for m in _TITLES.finditer(text):
        put(m.start(), _HEADED, 7)
    nested: list[str] = []
    depths, places = [0], [0]  # nesting from each place on
    for m in _TAGS.finditer(text):
        name = m.group(2).lower()
        if name in ("br", "hr"):
            put(m.end(), _LINED)
        elif not m.group(1):
            put(m.start(), _NESTED, len(nested))
            nested.append(name)
        elif name in nested:  # what wasn't closed within it ends too
            del nested[len(nested) - 1 - nested[::-1].index(name) :]
            put(m.end(), _NESTED, len(nested))
        depths.append(len(nested))
        places.append(m.end())
    for m in _PARAGRAPHS.finditer(text):
        put(m.end(), _NESTED, depths[bisect_right(places, m.start()) - 1])
    for m in _LINES.finditer(text):
        put(m.end(), _LINED, len(m.group(1).expandtabs(4)))
    for kind, pattern in ((_SENTENCE, _SENTENCES), (_CLAUSE, _CLAUSES)):
        for m in pattern.finditer(text):
            put(m.end(), kind)
    return sorted(found.items())


def cut_points(text: str, starts: list[int], limit: int, overlap: int) -> list[int]:
    """Indices of the tokens at which pieces begin; ``starts`` are the tokens' places in the text.

    The first piece holds at most ``limit`` tokens, later ones at most ``limit - overlap`` new ones.
    """
    marks: dict[int, tuple[int, int]] = {}  # first token of a node -> level of its boundary
    for place, level in boundaries(text):
        token = bisect_left(starts, place)
        if 0 < token < len(starts) and (token not in marks or level < marks[token]):
            marks[token] = level
    tokens = sorted(marks)
    cuts: list[int] = []

    def room(begin: int) -> int:
        return limit if begin == 0 else limit - overlap

    def pack(begin: int, end: int, lo: int, hi: int) -> None:
        """Cuts the node of the tokens from ``begin`` to ``end``, its inner boundaries being tokens[lo:hi]."""
        if end - begin <= room(begin):
            cuts.append(begin)
            return
        if lo == hi:  # no boundary left: cut between tokens
            while begin < end:
                cuts.append(begin)
                begin += room(begin)
            return
        top = min(marks[t] for t in tokens[lo:hi])
        inner = [k for k in range(lo, hi) if marks[tokens[k]] == top]
        firsts = [begin, *[tokens[k] for k in inner]]
        ends = [*firsts[1:], end]
        sides = list(zip([lo, *[k + 1 for k in inner]], [*inner, hi], strict=True))
        merged = None  # first token of the open run of merged siblings
        for a, z, (x, y) in zip(firsts, ends, sides, strict=True):
            if merged is not None and z - merged <= room(merged):
                continue
            if z - a <= room(a):
                cuts.append(a)
                merged = a
            else:
                merged = None
                pack(a, z, x, y)

    pack(0, len(starts), 0, len(tokens))
    return cuts


def split_text(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(start, end, tokens) of the pieces of a text; one piece if it isn't over the limit."""
    spans = [m.span() for m in _TOKEN.finditer(text)]
    if len(spans) <= limit:
        return [(0, len(text), len(spans))]
    starts = [a for a, _ in spans]
    cuts = cut_points(text, starts, limit, overlap)
    pieces = []
    for k, c in enumerate(cuts):
        first = c if k == 0 else max(c - overlap, 0)
        last = cuts[k + 1] if k + 1 < len(cuts) else len(spans)
        begin = 0 if k == 0 else starts[first]
        end = spans[last - 1][1] if last < len(spans) else len(text)
        pieces.append((begin, end, last - first))
    return pieces


def split_documents(documents: DataFrame, id: str = "doc_id", text: str = "text", limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Pieces of all texts of more than ``limit`` tokens: id, piece, n_pieces, start, n_tokens, piece_text.

    Every piece has at most ``limit`` tokens; each but the first begins with the last ``overlap``
    tokens of the one before (of a shorter one: with all of it). Without the overlaps the pieces
    join to the whole text. Null, empty and short texts have no piece; a text without any
    boundary is cut between tokens. Repeated ids are cut each. ``overlap`` is less than ``limit``.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and less than limit")
    kind = documents.schema[id].dataType
    schema = T.StructType(
        [T.StructField(id, kind)]
        + [T.StructField(c, T.IntegerType()) for c in ("piece", "n_pieces", "start", "n_tokens")]
        + [T.StructField("piece_text", T.StringType())]
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, t in zip(pdf[id], pdf[text], strict=True):
                pieces = split_text(t, limit, overlap)
                rows += [(key, k, len(pieces), a, n, t[a:b]) for k, (a, b, n) in enumerate(pieces)]
            yield pd.DataFrame(rows, columns=schema.names)

    # A text of n characters has at most n tokens, so the short ones are not even counted.
    large = documents.select(id, text).where((F.length(text) > limit) & (n_tokens(F.col(text)) > limit))
    return large.mapInPandas(cut, schema)


def checked_pieces(pieces: DataFrame, documents: DataFrame, id: str = "doc_id", text: str = "text", limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Per text that was cut: id, within_limit, overlapping, whole: what must hold of its pieces.

    The pieces are compared with the text itself: each is found where it says it begins, has no
    more tokens than the limit, begins with the last ``overlap`` tokens of the one before, and
    together they are the whole text. ``documents`` has distinct ids.
    """
    w = Window.partitionBy(id).orderBy("piece")
    size = F.length("piece_text")
    rows = pieces.withColumn("_end", F.col("start") + size).withColumn("_prev", F.lag("_end").over(w)).withColumn("_before", F.lag("n_tokens").over(w))
    rows = rows.join(documents.select(id, F.col(text).alias("_text")), id)
    there = F.col("_text").substr(F.col("start") + 1, size) == F.col("piece_text")
    shared = F.col("_text").substr(F.col("start") + 1, F.col("_prev") - F.col("start"))
    ends = F.when(F.col("piece") == F.col("n_pieces") - 1, F.col("_end") == F.length("_text")).otherwise(F.lit(True))
    begins = F.when(F.col("piece") == 0, F.col("start") == 0).otherwise(F.col("start") <= F.col("_prev"))
    return rows.groupBy(id).agg(
        F.bool_and((n_tokens(F.col("piece_text")) == F.col("n_tokens")) & (F.col("n_tokens") <= limit)).alias("within_limit"),
        F.bool_and(F.col("_prev").isNull() | (n_tokens(shared) == F.least("_before", F.lit(overlap)))).alias("overlapping"),
        F.bool_and(there & ends & begins & (F.col("n_pieces") > 1)).alias("whole"),
    )
