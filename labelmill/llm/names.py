"""Variant spellings of names typed by people, linked by metric-space partitioning.

A name is read into a profile: kind (company, person or acronym), core (the tokens that name it,
in any order), and attributes that tell namesakes apart (direction, kind of business, first name
and initial). Short forms of the words of cores are learnt from the names. Cores are compared by the Damerau-Levenshtein distance, a true metric: every core
is assigned to its nearest pivot and replicated to each pivot whose cell may hold a core within
the radius by the triangle inequality; the exact radius join runs inside the cells. Profiles whose
cores are near and whose attributes agree are linked; spellings of linked profiles are one entity.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelmill.llm.components import components
from labelmill.session import materialize

#: Distance up to which two cores are one (an insertion, removal, change or swap of neighbours).
RADIUS = 1
#: Pivots of the metric space; the first ``RINGS`` also prune pairs inside a cell.
PIVOTS, RINGS = 24, 4
#: A word is taken for a short form of another if both stand beside so many same other words, and no other word has half as much evidence.
SUPPORT = 3
#: Short forms are learnt of words of ``LONG`` letters, from names of at most ``NAME_WORDS`` words; all names are then read with them.
LONG, NAME_WORDS = (5, 30), 8
#: Words of at most ``LETTERS`` letters are compared ``CHUNK`` at a time, longer ones one by one.
LETTERS, CHUNK = 48, 256

# Legal forms, left out.
LEGAL = "inc incorporated llc ltd limited co company corp corporation plc gmbh sa ag lp llp mfr the of".split()
# Kinds of business and their spellings.
BUSINESS = {
    "compounding pharmacy": "compounding pharmacy|compounding pharm|compounding rx|cmpd pharmacy|cmpd pharm|cmpd rx|cp",
    "drug company": "drug company|drug co|drugs|drug",
    "apothecary": "apothecary|apoth|apothecry|apothecaries",
    "consumer healthcare": "consumer healthcare|consumer health care|consumer health|cons hlthcare|cons health|cons healthcare|chc",
    "pharmaceuticals": "pharmaceuticals|pharmaceutical|pharmaceutcals|pharma|pharms|pharm",
    "therapeutics": "therapeutics|therapeutic|theraputics|therap|tx",
    "biosciences": "biosciences|bioscience|bio sciences|bio science|biosci",
    "laboratories": "laboratories|laboratory|labratories|labs|lab",
    "manufacturing": "manufacturing|manufacturng|mfg|manufacturers|manufacturer",
    "international": "international|internatl|intl|int l",
}
# Kinds of business that persons run under their own name.
PERSONAL = {"compounding pharmacy", "drug company", "apothecary"}
# First names and their short forms.
FIRST_NAMES = {
    "william": "bill will billy", "richard": "dick rick rich", "robert": "bob rob bobby", "margaret": "peggy meg maggie", "dorothea": "dot dottie dora",
    "susannah": "sue susan susie", "elizabeth": "liz beth betty eliza", "katherine": "kate kathy katie", "theodore": "ted teddy theo",
    "frederick": "fred freddy", "josephine": "jo josie", "edward": "ned eddie ed", "james": "jim jimmy", "john": "jack johnny", "charles": "charlie chuck",
    "thomas": "tom tommy", "michael": "mike mick", "joseph": "joe joey", "henry": "harry hank", "alexander": "alex sandy", "catherine": "cathy",
    "patricia": "pat patty", "rebecca": "becky", "samuel": "sam", "benjamin": "ben", "daniel": "dan danny", "anthony": "tony", "andrew": "andy drew",
}
# Directions and their short forms.
DIRECTIONS = {"north": "n", "south": "s", "east": "e", "west": "w"}

_PHRASES = sorted(((p.split(), kind) for kind, ps in BUSINESS.items() for p in ps.split("|")), key=lambda x: -len(x[0]))
_FIRST = {s: full for full, short in FIRST_NAMES.items() for s in [full, *short.split()]}


def distance(a: str, b: str) -> int:
    """Damerau-Levenshtein distance with unrestricted swaps (a metric)."""
    if a == b:
        return 0
    last: dict[str, int] = {}
    big = len(a) + len(b)
    d = [[big] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        d[i + 1][1] = i
    for j in range(len(b) + 1):
        d[1][j + 1] = j
    for i, x in enumerate(a, 1):
        match = 0
        row, above = d[i + 1], d[i]
        for j, y in enumerate(b, 1):
            k, m = last.get(y, 0), match
            cost = 1
            if x == y:
                cost, match = 0, j
            row[j + 1] = min(above[j] + cost, row[j] + 1, above[j + 1] + 1, d[k][m] + (i - k - 1) + 1 + (j - m - 1))
        last[x] = i
    return d[len(a) + 1][len(b) + 1]


def _letters(words: list[str], pad: int) -> np.ndarray:
    """Code points of the words, one row each, padded to the longest."""
    out = np.full((len(words), max(map(len, words))), pad, np.int32)
    for row, word in zip(out, words, strict=True):
        row[: len(word)] = [ord(c) for c in word]
    return out


def distances(words: list[str], points: list[str]) -> np.ndarray:
    """``distance`` of every word to every point, one row a word: one step of the table is taken for all of them at once."""
    out = np.empty((len(words), len(points)), np.int32)
    short = [k for k, w in enumerate(words) if 0 < len(w) <= LETTERS]
    near = [k for k, p in enumerate(points) if 0 < len(p) <= LETTERS]
    rest = set(range(len(words))) - set(short), set(range(len(points))) - set(near)
    for i in range(len(words)):
        for j in range(len(points)) if i in rest[0] else rest[1]:
            out[i, j] = distance(words[i], points[j])
    if not near:
        return out
    b = _letters([points[k] for k in near], -1)
    for at in range(0, len(short), CHUNK):
        rows = short[at : at + CHUNK]
        a = _letters([words[k] for k in rows], -2)
        n, m, shape = a.shape[1], b.shape[1], (len(rows), len(near))
        d = np.full((n + 2, m + 2, *shape), n + m, np.int32)
        d[1:, 1] = np.arange(n + 1)[:, None, None]
        d[1, 1:] = np.arange(m + 1)[:, None, None]
        last = np.zeros((m, *shape), np.int32)
        for i in range(1, n + 1):
            match = np.zeros(shape, np.int32)
            for j in range(1, m + 1):
                equal = a[:, i - 1, None] == b[None, :, j - 1]
                step = np.minimum(np.minimum(d[i, j + 1], d[i + 1, j]) + 1, d[i, j] + (1 - equal))
                k = last[j - 1]
                x, y = np.nonzero((k > 0) & (match > 0))
                if len(x):
                    k, l = k[x, y], match[x, y]
                    step[x, y] = np.minimum(step[x, y], d[k, l, x, y] + (i - k - 1) + 1 + (j - l - 1))
                d[i + 1, j + 1] = step
                match[equal] = j
                last[j - 1][equal] = i
        ends = d[[[len(words[k]) + 1] for k in rows], [[len(points[k]) + 1 for k in near]], np.arange(len(rows))[:, None], np.arange(len(near))]
        out[np.ix_(rows, near)] = ends
    return out


def _near(word: str, known: str, least: int = 7) -> bool:
    """Equal, or one step apart where the known word is long enough to be told from others."""
    if word == known:
        return True
    return len(known) >= least and abs(len(word) - len(known)) <= 1 and len(set(word) ^ set(known)) <= 2 and distance(word, known) <= 1


def read_name(name: str) -> dict[str, str | list[str] | None]:
    """The profile of a name: kind, core, alias (the core as typed), business, direction, first, middle, initials, words (of a company's core)."""
    s = name.lower().replace("'", "").replace("’", "")
    s = re.sub(r"\b(?:[^\W\d_]\.){2,}", lambda m: m.group().replace(".", ""), s)
    s = re.sub(r"[&+]", " and ", s)
    tokens = re.findall(r"[^\W_]+", s)
    while (at := next((i for i in range(len(tokens) - 2) if tokens[i : i + 3] == ["l", "l", "c"]), None)) is not None:
        tokens[at : at + 3] = ["llc"]
    business = None
    for phrase, kind in _PHRASES:
        n = len(phrase)
        at = next((i for i in range(len(tokens) - n + 1) if all(map(_near, tokens[i : i + n], phrase))), None)
        if at is not None and n < len(tokens):
            business, tokens = kind, tokens[:at] + tokens[at + n :]
            break
    core = [t for t in tokens if t not in LEGAL and t != "and"] or tokens
    out = dict.fromkeys(("kind", "core", "alias", "business", "direction", "first", "middle", "initials", "words"))
    out["business"] = business
    if business in PERSONAL:
        single = [t for t in core if len(t) == 1]
        named = [(t, f) for t in core if len(t) > 1 for k, f in _FIRST.items() if _near(t, k, 5)][:1]
        rest = [t for t in core if len(t) > 1 and not (named and t == named[0][0])]
        if rest and (named or single):
            out["kind"] = "person"
            out["first"] = named[0][1] if named else single[0]
            left = single if named else single[1:]
            out["middle"] = left[0] if left else None
            out["core"] = out["alias"] = "".join(rest)
            return out
    points = []
    for t in core:
        way = next((w for w, c in DIRECTIONS.items() if t in (w, c) or (len(t) >= 4 and t[0] == w[0] and distance(t, w) <= 1)), None)
        points.append(way)
    if any(points) and not all(points):
        out["direction"] = next(p for p in points if p)
        core = [t for t, p in zip(core, points, strict=True) if not p]
    out["kind"] = "acronym" if len(core) == 1 and len(core[0]) <= 5 else "company"
    out["alias"] = "".join(core)
    out["core"] = "".join(sorted(core))
    out["words"] = core
    if len(core) >= 3:
        out["initials"] = "".join(t[0] for t in core)
    return out


_PROFILE = T.StructType([T.StructField(c, T.StringType()) for c in ("kind", "core", "alias", "business", "direction", "first", "middle", "initials")] + [T.StructField("words", T.ArrayType(T.StringType()))])


@F.pandas_udf(_PROFILE)
def _read(names: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_name(n) for n in names], columns=_PROFILE.names)


def _short_forms(word: Column) -> Column:
    """What a word may be shortened to: its beginnings of three letters or more, its first and two later letters, its first, two inner and last letter."""
    n = F.length(word)
    letter = lambda i: F.substring(word, i, F.lit(1))
    starts = F.transform(F.sequence(F.lit(3), n - 2), lambda i: F.substring(word, F.lit(1), i))
    two = F.flatten(F.transform(F.sequence(F.lit(2), n - 1), lambda i: F.transform(F.sequence(i + 1, n), lambda j: F.concat(letter(i), letter(j)))))
    three = F.transform(two, lambda x: F.concat(letter(F.lit(1)), x))
    four = F.transform(two, lambda x: F.concat(letter(F.lit(1)), x, letter(n)))
    return F.array_distinct(F.concat(starts, three, four))


def learn_abbreviations(read: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(short, long): words of the names that are short forms of others, learnt from the names themselves.

    ``read`` has ``words``, the words of each company's core. Two words are evidence for each other where the
    same other words stand beside both (``Vurkarto Nutr``, ``Vurkarto Nutritionals``), provided that
    the long word has at least as many kinds of company as those other words have kinds of
    business: words that only name few companies teach nothing. Every (rest, short form) is matched
    by equality, so the work grows with the names. An empty table and null words give no rows.
    """
    at = read.where(F.size("words").between(2, NAME_WORDS)).select("words", F.posexplode("words").alias("i", "t"))
    rest = F.xxhash64(F.array_sort(F.filter("words", lambda w, j: j != F.col("i"))))
    rows = materialize(at.select("t", rest.alias("rest")).distinct())
    general = rows.groupBy("t").agg(F.count("*").alias("n_rests")).where(F.col("n_rests") >= support)
    beside = rows.groupBy("rest").agg(F.count("*").alias("n_words"))
    longs = rows.where(F.length("t").between(*LONG)).join(general, "t").join(beside, "rest").where("n_rests >= n_words")
    forms = longs.select("rest", F.col("t").alias("long"), F.explode(_short_forms(F.col("t"))).alias("t"))
    pairs = forms.join(rows, ["rest", "t"]).groupBy(F.col("t").alias("short"), "long").agg(F.count("*").alias("n")).where(F.col("n") >= support)
    order = Window.partitionBy("short").orderBy(F.desc("n"), "long")
    ranked = pairs.withColumn("r", F.row_number().over(order)).withColumn("next", F.lead("n", 1, 0).over(order))
    return materialize(ranked.where("r = 1 and n >= 2 * next").select("short", "long"))


def _spelled_out(read: DataFrame) -> DataFrame:
    """The names with learnt short forms in their cores written in full; a short form of a short form is followed once."""
    learnt = learn_abbreviations(read)
    further = learnt.select(F.col("short").alias("long"), F.col("long").alias("longer"))
    full = learnt.join(further, "long", "left").select(F.col("short").alias("t"), F.coalesce("longer", "long").alias("full"))
    words = read.where("size(words) > 1").select("name", F.posexplode("words").alias("i", "t"))
    concerned = words.join(full, "t", "left_semi").select("name").distinct()
    whole = words.join(concerned, "name", "left_semi").join(full, "t", "left")
    written = whole.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("i", F.coalesce("full", "t").alias("w"))))["w"].alias("w"))
    written = written.select("name", F.array_join(F.array_sort("w"), "").alias("_core"), F.array_join("w", "").alias("_alias"))
    out = read.join(written, "name", "left").withColumn("core", F.coalesce("_core", "core")).withColumn("alias", F.coalesce("_alias", "alias"))
    return materialize(out.drop("_core", "_alias", "words"))


def _pivots(cores: DataFrame, n: int) -> list[str]:
    """``n`` cores by hash, a bounded sample: any pivots give the same result, good ones give small cells."""
    return [r.core for r in cores.orderBy(F.xxhash64("core"), "core").limit(n).collect()]


def near_cores(cores: DataFrame, radius: int = RADIUS, pivots: int = PIVOTS) -> DataFrame:
    """Pairs (block, x, y) of different cores of one block within ``radius``, x < y.

    ``cores`` has distinct (block, core). A core's home is its nearest pivot; it also visits each
    pivot at most ``2 * radius`` farther away, for a core within the radius may live there.
    """
    points = _pivots(cores.select("core").distinct(), pivots)
    if not points:
        return cores.select("block", F.col("core").alias("x"), F.col("core").alias("y")).limit(0)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def to_pivots(col: pd.Series) -> pd.Series:
        return pd.Series(list(distances(col.tolist(), points)), dtype=object)

    # A fixed number of tasks: distances are costly for their rows' size, so small partitions aren't merged.
    tasks = int(cores.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(cores.repartition(tasks, "core").withColumn("d", to_pivots("core")))
    nearest = F.array_min("d")
    rings = [F.get("d", F.lit(k)).alias(f"d{k}") for k in range(min(RINGS, len(points)))]
    home = placed.select("block", "core", *rings, (F.array_position("d", nearest) - 1).cast("int").alias("cell"))
    visits = F.filter(F.sequence(F.lit(0), F.lit(len(points) - 1)), lambda k: F.get("d", k) <= nearest + 2 * radius)
    visitors = placed.select("block", "core", *rings, F.explode(visits).alias("cell"))
    a, b = home.alias("a"), visitors.alias("b")
    on = [F.col("a.block") == F.col("b.block"), F.col("a.cell") == F.col("b.cell"), F.col("a.core") != F.col("b.core")]
    on += [F.abs(F.length("a.core") - F.length("b.core")) <= radius]
    on += [F.abs(F.col(f"a.d{k}") - F.col(f"b.d{k}")) <= radius for k in range(len(rings))]
    # A swap is one step of the metric but two of Levenshtein's, which is quicker and never less.
    on += [F.levenshtein("a.core", "b.core") <= 2 * radius]
    near = a.join(b, on).select(F.col("a.block").alias("block"), F.least("a.core", "b.core").alias("x"), F.greatest("a.core", "b.core").alias("y")).distinct()

    @F.pandas_udf(T.BooleanType())
    def within(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([distance(p, q) <= radius for p, q in zip(x, y, strict=True)])

    return near.where(within("x", "y"))


def _agree(a: str, b: str) -> str:
    """SQL: the attributes of two profiles don't contradict each other."""
    first = f"""({a}.first <=> {b}.first OR {a}.first IS NULL OR {b}.first IS NULL OR
        (least(length({a}.first), length({b}.first)) = 1 AND left({a}.first, 1) = left({b}.first, 1)))"""
    open_ = " AND ".join(f"({a}.{c} = {b}.{c} OR {a}.{c} IS NULL OR {b}.{c} IS NULL)" for c in ("business", "middle"))
    return f"{first} AND {open_} AND {a}.direction <=> {b}.direction"


def link_names(names: DataFrame, name: str = "name") -> DataFrame:
    """One row per distinct non-null name: name, entity, kind, core. Names of one entity are spellings of it.

    ``entity`` is a hash that stands for the component. Blank names and names without a letter or
    digit are entities of their own. A spelling without an attribute (a bare initial, no kind of
    business) is linked only where that doesn't join entities that differ in it.
    """
    distinct = names.select(F.col(name).alias("name")).where("name is not null").distinct()
    parts = ["kind", "core", "alias", "business", "direction", "first", "middle", "initials"]
    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    read = materialize(distinct.repartition(tasks, "name").withColumn("p", _read("name")).select("name", *[F.col(f"p.{c}").alias(c) for c in [*parts, "words"]]))
    read = _spelled_out(read)
    read = read.withColumn("pid", F.when(F.coalesce("core", F.lit("")) == "", F.xxhash64("name")).otherwise(F.xxhash64(*[F.coalesce(c, F.lit("\0")) for c in parts if c not in ("alias", "initials")])))
    usable = read.where("coalesce(core, '') != ''")
    profiles = materialize(usable.groupBy("pid", *[c for c in parts if c not in ("alias", "initials")]).agg(F.max("initials").alias("initials"), F.collect_set("alias").alias("aliases")))
    # What has to be equal anyway is the block of the join; a core is looked up as sorted and as typed.
    block = F.concat_ws("/", "kind", F.coalesce("direction", F.lit("-")))
    keys = profiles.select("pid", block.alias("block"), F.explode(F.array_distinct(F.concat(F.array("core"), "aliases"))).alias("core"))
    keys = materialize(keys)
    near = near_cores(keys.where("block not like 'acronym%'").select("block", "core").distinct())
    same = keys.select("block", F.col("core").alias("x"), F.col("core").alias("y")).distinct()
    pairs = near.unionByName(same)
    met = pairs.join(keys.select("block", F.col("core").alias("x"), F.col("pid").alias("p")), ["block", "x"]).join(
        keys.select("block", F.col("core").alias("y"), F.col("pid").alias("q")), ["block", "y"]
    )
    acronyms = profiles.where("kind = 'acronym'").select(F.col("core").alias("k"), F.col("pid").alias("p"))
    long = profiles.where("initials is not null and direction is null").select(F.col("initials").alias("k"), F.col("pid").alias("q"))
    met = met.select("p", "q").unionByName(acronyms.join(long, "k").select("p", "q")).where("p != q")
    met = met.select(F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q")).distinct()
    slim = profiles.select("pid", "business", "direction", "first", "middle")
    a, b = slim.withColumnRenamed("pid", "p").alias("a"), slim.withColumnRenamed("pid", "q").alias("b")
    links = materialize(met.join(a, "p").join(b, "q").where(_agree("a", "b")).select(
        "p", "q", *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in ("a", "b") for c in ("business", "first", "middle")]
    ))
    # A profile that leaves an attribute open may not bridge profiles that differ in it.
    both = links.select(F.col("p").alias("u"), *[F.col(f"a_{c}").alias(c) for c in ("business", "first", "middle")], *[F.col(f"b_{c}").alias(f"o_{c}") for c in ("business", "first", "middle")])
    both = both.unionByName(
        links.select(F.col("q").alias("u"), *[F.col(f"b_{c}").alias(c) for c in ("business", "first", "middle")], *[F.col(f"a_{c}").alias(f"o_{c}") for c in ("business", "first", "middle")])
    )
    seen = both.groupBy("u").agg(
        F.count_distinct(F.when(F.col("business").isNull(), F.col("o_business"))).alias("n_business"),
        F.count_distinct(F.when(F.col("middle").isNull(), F.col("o_middle"))).alias("n_middle"),
        F.count_distinct(F.when(F.length("first") == 1, F.when(F.length("o_first") > 1, F.col("o_first")))).alias("n_first"),
    )
    # Such a profile loses the links to the profiles it would join, not those to others that leave the attribute open too.
    marks = materialize(seen.where("n_business > 1 or n_middle > 1 or n_first > 1").select("u", *[(F.col(f"n_{c}") > 1).alias(f"m_{c}") for c in ("business", "middle", "first")]))
    kept = links.withColumn("_cut", F.lit(False))
    for me, other, key in (("a", "b", "p"), ("b", "a", "q")):
        bridging = F.lit(False)
        for c in ("business", "middle"):
            bridging |= F.coalesce(f"m_{c}", F.lit(False)) & F.col(f"{me}_{c}").isNull() & F.col(f"{other}_{c}").isNotNull()
        initial = F.coalesce(F.length(f"{me}_first") == 1, F.lit(False)) & F.coalesce(F.length(f"{other}_first") > 1, F.lit(False))
        bridging |= F.coalesce("m_first", F.lit(False)) & initial
        kept = kept.join(marks.withColumnRenamed("u", key), key, "left").withColumn("_cut", F.col("_cut") | bridging).drop("m_business", "m_middle", "m_first")
    kept = materialize(kept.where("not _cut").select("p", "q"))
    entity = components(kept, "p", "q").withColumnRenamed("node", "pid")
    return read.join(entity, "pid", "left").select("name", F.coalesce("component", "pid").alias("entity"), "kind", "core")


def name_pairs(linked: DataFrame) -> DataFrame:
    """(name_a, name_b) of all different spellings of one entity, name_a < name_b by code points."""
    a, b = linked.alias("a"), linked.alias("b")
    return a.join(b, [F.col("a.entity") == F.col("b.entity"), F.col("a.name") < F.col("b.name")]).select(
        F.col("a.name").alias("name_a"), F.col("b.name").alias("name_b")
    )
