"""Text operators against brute force, round trips and edge cases."""

import itertools
import collections
import random
import re
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labelmill.llm import components, leakage, mixing, names, neardup, reading, splitting
from labelmill.llm.tokens import TOKEN_PY, n_tokens, words

WORDS = [f"w{i}" for i in range(400)]


def shingled(text, k):
    w = re.findall(r"[^\W_]+", text.lower())
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def edited(rnd, text, n):
    w = text.split()
    for _ in range(n):
        i = rnd.randrange(len(w))
        w[i : i + 1] = rnd.choice([[], [rnd.choice(WORDS)], [w[i], rnd.choice(WORDS)]])
    return " ".join(w)


def test_tokens(spark):
    df = spark.createDataFrame([("Añb_1, x!! 5%",), ("",), (None,)], "t string")
    assert [r.n for r in df.select(n_tokens(F.col("t")).alias("n")).collect()] == [6, 0, 0]
    assert [r.w for r in df.select(words(F.col("t")).alias("w")).collect()] == [["añb", "1", "x", "5"], [], []]


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(5)
    texts = []
    for g in range(40):
        base = " ".join(rnd.choice(WORDS) for _ in range(rnd.randrange(60, 120)))
        texts += [edited(rnd, base, k) for k in (0, 0, 1, 2, 3, 5, 12)]
    rows = [(f"id{i:04d}", "f" if i % 2 else "g", t, 1) for i, t in enumerate(texts)]
    rows += [("null", "f", None, 1), ("empty", "f", "", 1), ("short", "f", "one two", 1), ("id0000", "g", texts[0], 2), (None, "g", texts[3], 1)]
    return spark.createDataFrame(rows, "id string, field string, text string, at int")


@pytest.mark.parametrize("width, threshold", [(5, 0.8), (3, 0.65)])
def test_near_duplicates(corpus, width, threshold):
    rows = {(r.field, r.id): r.text for r in corpus.where("id is not null and text is not null").collect()}
    sets = {k: shingled(t, width) for k, t in rows.items() if len(re.findall(r"\w+", t)) >= 20}
    want = {
        (a[0], *sorted((a[1], b[1])))
        for a, b in itertools.combinations(sets, 2)
        if a[0] == b[0] and a[1] != b[1] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])
    }
    got = [tuple(r) for r in neardup.similar_pairs(corpus.where("id is not null"), "id", "text", ["field"], "at", width, threshold, 20).collect()]
    assert len(got) == len(set(got)) and set(got) <= want
    assert len(want) > 50 and len(got) >= 0.97 * len(want)


def test_duplicate_groups(corpus):
    rows = neardup.duplicate_groups(corpus.where("id is not null"), "id", "text", ["field"], "at", least=20).collect()
    assert len(rows) == 280 and len({r.cluster for r in rows}) < len({r.cls for r in rows})
    assert neardup.duplicate_groups(corpus.limit(0), "id", "text").count() == 0


def test_long_text(spark):
    long = " ".join(str(i) for i in range(60_000))
    df = spark.createDataFrame([("a", long), ("b", long + " end")], "id string, text string")
    assert [tuple(r) for r in neardup.similar_pairs(df, "id", "text").collect()] == [("a", "b")]


def test_components(spark):
    rnd = random.Random(3)
    links = [(f"n{i}", f"n{i + 1}") for i in range(60)] + [(f"m{rnd.randrange(40)}", f"m{rnd.randrange(40)}") for _ in range(30)] + [("x", None)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a string, b string"), "a", "b").collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if b is not None:
            parent[find(a)] = find(b)
    groups = {}
    for n in parent:
        groups.setdefault(find(n), []).append(n)
    assert got == {n: min(g) for g in groups.values() for n in g}


ENTITIES = [
    ["Vurkartonum Pharmaceuticals, Company", "Pharmaceuticals Vurkartonum", "Vurkaartonum Pharma Co.", "VURKARTONUM PHARMS"],
    ["Kellertoand East Manufacturing", "Kellertoand E. Mfg.", "East Kellertoand Mfg"],
    ["Kellertoand West Manufacturing", "Kellertoand W. Mfg."],
    ["Agelven Ksankon Aborvut Anekuld International", "A.K.A.A. Intl", "AKAA Int'l"],
    ["Burgarg & Neltenron Manufacturing", "Neltenron and Burgarg Mfg", "Burgarg + Neltenron"],
    ["Elizabeth A. Bupenleeth Apothecary", "Liz Bupenleeth Apoth.", "Bupenleeth, Elizabeth A - Apothecary", "Elizabteh A Bupenleeth Apothecry"],
    ["Katherine M. Bupenleeth Apothecary", "K. M. Bupenleeth Apothecary"],
    ["Kenraponock Biosciences of Wexcombe", "Kenraponock of Wexcombe", "Wexcombe Kenraponock Biosci"],
    ["Zalmurmelis Manufacturing, Limited (mfr)", "Zal murmelis Mfg"],
    ["!!"], [""],
]


def test_names(spark):
    rows = [(n, 1) for e in ENTITIES for n in e] + [(None, 1), (ENTITIES[0][0], 2)]
    got = {}
    for r in names.link_names(spark.createDataFrame(rows, "name string, entity int")).collect():
        got.setdefault(r.entity, set()).add(r.name)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, ENTITIES))
    pairs = names.name_pairs(names.link_names(spark.createDataFrame(rows, "name string, x int"))).collect()
    assert len(pairs) == sum(len(e) * (len(e) - 1) // 2 for e in ENTITIES) and all(r.name_a < r.name_b for r in pairs)
    assert names.link_names(spark.createDataFrame([], "name string")).count() == 0


def test_near_cores_are_exact(spark):
    rnd = random.Random(9)
    cores = {"".join(rnd.choice("abc") for _ in range(rnd.randrange(3, 8))) for _ in range(150)}
    df = spark.createDataFrame([("b", c) for c in cores], "block string, core string")
    got = {(r.x, r.y) for r in names.near_cores(df, radius=1, pivots=6).collect()}
    assert got == {(a, b) for a, b in itertools.combinations(sorted(cores), 2) if names.distance(a, b) <= 1}


@settings(max_examples=60, deadline=None)
@given(*[st.text(alphabet="abc", max_size=5)] * 3)
def test_distance_is_a_metric(a, b, c):
    assert names.distance(a, b) == names.distance(b, a)
    assert (names.distance(a, b) == 0) == (a == b)
    assert names.distance(a, c) <= names.distance(a, b) + names.distance(b, c)


def test_reading_levels(spark):
    easy, hard = "the cat sat on a red mat and then it ran to me. ", "notwithstanding pharmacokinetic considerations hepatocellular metabolism remains unpredictable throughout administration. "
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.sample((easy * 4).split(), 40)), "x") for i in range(30)] + [(100 + i, " ".join(rnd.sample((hard * 6).split(), 40)), "x") for i in range(30)]
    rows += [(200, None, "x"), (201, "", "x"), (202, "short text", "x"), (203, "1 2 3 " * 20, "x")]
    df = spark.createDataFrame(rows, "id int, text string, rank string")
    anchors = spark.createDataFrame([(easy * 4, "plain"), (easy * 5, "plain"), (hard * 5, "expert"), (hard * 6, "expert")], "text string, band string")
    got = {r.id: r.band for r in reading.reading_levels(df, ["id"], "text", anchors).collect()}
    assert all(got[i] == "plain" for i in range(30)) and all(got[100 + i] == "expert" for i in range(30))
    assert [got[i] for i in (200, 201, 202, 203)] == [None] * 4
    assert {r.band for r in reading.reading_levels(df, ["id"], "text", anchors.limit(0)).collect()} == {None}
    top = reading.vocabulary(df, "text").orderBy("rank").collect()
    assert [r.n for r in top] == sorted((r.n for r in top), reverse=True) and [r.rank for r in top] == list(range(1, len(top) + 1))


def test_leaks(spark):
    rnd = random.Random(4)
    item = " ".join(rnd.choice(WORDS) for _ in range(60))
    other = " ".join(rnd.choice(WORDS) for _ in range(45))
    fill = lambda n: " ".join(f"z{rnd.randrange(3000)}" for _ in range(n))
    w = item.split()
    docs = {
        1: f"{fill(200)} {item} {fill(100)}",
        2: f"{fill(50)} {' '.join(w[:20])} {fill(80)} {' '.join(w[35:55])} {fill(10)}",
        3: "<p>" + " ".join(f"<b>{x}</b>" for x in item.upper().split()) + "</p>",
        4: f"{fill(30)} {edited(rnd, item, 4)}",
        5: f"{fill(80)} {' '.join(w[:12])} {fill(80)}",
        6: fill(400),
        7: None,
        8: "",
        9: " ".join(rnd.sample(w, len(w))),
    }
    d = spark.createDataFrame([(k, t, "c") for k, t in docs.items()], "doc_id long, text string, item string")
    items = spark.createDataFrame([(1, item), (2, other), (3, None), (4, "a b"), (5, "")], "item_id long, text string")
    got = {(r.item_id, r.doc_id) for r in leakage.leaks(d, items).collect()}
    assert got == {(1, k) for k in (1, 2, 3, 4)}
    named = d.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert {r.doc_id for r in leakage.leaks(named, items).collect()} == {"d1", "d2", "d3", "d4"}
    assert leakage.leaks(d, items.limit(0)).count() == 0
    assert leakage.leaks(d.limit(0), items).count() == 0


def test_more_items_than_a_pass(spark, monkeypatch):
    monkeypatch.setattr(leakage, "ITEMS_AT_ONCE", 3)
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice(WORDS) for _ in range(30)) for _ in range(10)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = spark.createDataFrame([(100 + i, f"before {t} after") for i, t in enumerate(texts)], "doc_id long, text string")
    assert {(r.item_id, r.doc_id) for r in leakage.leaks(docs, items).collect()} == {(i, 100 + i) for i in range(10)}


@pytest.mark.parametrize(("width", "stride"), [(1, 1), (2, 1), (7, 2), (8, 1), (32, 8), (41, 3)])
def test_simhashes_are_the_majority_of_each_bit(width, stride):
    """Against counting; the work space is a few words a word, not the 64 counts of each word."""
    words = np.random.default_rng(5).integers(0, 2**63, 20_000).astype(np.uint64)
    words[5000:5100] = words[5000]
    tracemalloc.start()
    found = leakage.simhashes(words, width, stride)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    bits = np.unpackbits(words.view(np.uint8).reshape(-1, 8), axis=1)
    for k, at in enumerate(range(0, len(words) - width + 1, stride)):
        if k % 97 == 0 or 4900 < at < 5200:
            assert found[k] == np.packbits(2 * bits[at : at + width].sum(0, dtype=int) > width).view(np.uint64)[0]
    assert len(found) == len(range(0, len(words) - width + 1, stride)) and not len(leakage.simhashes(words[: width - 1], width, stride))
    assert peak < 160 * len(words)


@pytest.mark.parametrize("width", leakage.WINDOWS)
def test_block_tables_find_all_within_radius(width):
    rnd = np.random.default_rng(2)
    radius, _ = leakage.WINDOWS[width]
    items = [rnd.integers(0, 2**63, 80).astype(np.uint64) for _ in range(20)]
    blocks = leakage.Blocks(items, width, radius, 1)
    flips = np.array([sum(1 << int(b) for b in rnd.choice(64, radius, replace=False)) for _ in range(len(blocks.prints))], np.uint64)
    changed = blocks.prints ^ flips
    original = leakage.simhashes
    leakage.simhashes = lambda words, *_: changed
    try:
        at, found = blocks.collisions(items[0])
    finally:
        leakage.simhashes = original
    assert set(zip(range(len(changed)), blocks.owner.tolist(), strict=True)) <= set(zip(at.tolist(), found.tolist(), strict=True))


def test_short_items_and_parts(spark):
    """Items shorter than a window, halves shorter than a window, documents shorter than one."""
    docs = [(1, "alpha beta gamma delta epsilon zeta"), (2, "so alpha beta gamma delta epsilon zeta it is"), (3, "x k1 k2 k3 k4 k5 k6 k7 y"), (4, "one two three"), (5, "k1 k2 k3 z")]
    items = [(10, "Alpha beta gamma delta epsilon zeta"), (11, "k1 k2 k3 k4 k5 k6 k7 k8 k9 k10 k11 k12"), (12, "one two three")]
    got = leakage.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.item_id, r.doc_id) for r in got.collect()} == {(10, 1), (10, 2), (11, 3), (12, 4)}


def test_candidates_of_changed_items():
    """Whole and half items with 5-20 % of the words changed, lost or added are candidates; halves of the shortest may lie below a run."""
    rnd = random.Random(12)
    items = [np.array([rnd.getrandbits(63) for _ in range(n)], np.uint64) for n in (5, 8, 12, 20, 40, 80, 150) for _ in range(20)]
    index = leakage.Index(items)
    lost = tried = 0
    for k, w in enumerate(items):
        for part in (w, w[: (len(w) + 1) // 2]):
            for rate in (0.05, 0.1, 0.2):
                out = []
                for x in part.tolist():
                    what = rnd.random()
                    out += [rnd.getrandbits(63)] if what < rate / 3 else [] if what < 2 * rate / 3 else [x, rnd.getrandbits(63)] if what < rate else [x]
                doc = np.array([rnd.getrandbits(63) for _ in range(30)] + out + [rnd.getrandbits(63) for _ in range(30)], np.uint64)
                pairs = index.candidates(doc, np.zeros(len(doc), np.int64))
                # Half of the words must still be there.
                if len(set(part.tolist()) & set(out)) * 2 >= len(w) and len(part) >= leakage.RUN:
                    tried += 1
                    lost += k not in pairs[1]
    assert tried > 400 and lost / tried < 0.05, (lost, tried)


def test_places_that_repeat():
    """A passage that repeats within the item is held where it goes on; many stretches between don't hide one."""
    item = np.array([1, 2, 3, 4, 5, 6, 7, 8, 9, 10], np.uint64)
    codes = leakage.shingles(item, 1)
    repeated = np.concatenate([codes[:2], codes[5:7], codes[:2], codes[2:5]])
    assert len(leakage.shared_in_order(codes[:5], repeated)) == 5
    noise = np.array([x for k in range(20) for x in (codes[9], codes[0], codes[8])], np.uint64)
    assert len(leakage.shared_in_order(np.concatenate([noise[:6], codes]), codes)) == 10


def test_mix(spark):
    rnd = random.Random(6)
    rows = [(i, "a b c " * rnd.randrange(1, 9), rnd.choice(["x", " X ", "x", "x", "y", "Y\t", "z", "other", None])) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("x", 0.4, 2), ("y", 0.4, 3), ("z", 0.2, 1), ("none", 0.0, 2)], "source string, target_share double, max_repeats int")
    sizes = {r.source: r for r in mixing.expected_copies(mixing.source_sizes(docs, targets)).collect()}
    mixed = mixing.mix(docs, targets)
    copies = {r.doc_id: r.n_copies for r in mixed.collect()}
    for s, row in sizes.items():
        ids = [i for i, _, x in rows if x and x.strip().lower() == s]
        n = [copies.get(i, 0) for i in ids]
        assert row.size == sum(len(re.findall(TOKEN_PY, t)) for i, t, x in rows if i in set(ids))
        if ids:
            assert max(n) <= row.max_repeats and max(n) - min(n) <= 1
            assert abs(sum(n) - row.copies * len(ids)) < 1.001
    assert copies == {r.doc_id: r.n_copies for r in mixing.mix(docs.repartition(7), targets).collect()}
    shares = {r.source: r.share for r in mixing.reached_shares(mixed, targets).collect()}
    assert abs(sum(shares.values()) - 1) < 1e-9 and shares["none"] == 0.0
    assert mixing.mix(docs.limit(0), targets).count() == 0


@settings(max_examples=40, deadline=None)
@given(t=st.lists(st.sampled_from(["word ", "two words. ", "\n\n", "HEADING LINE\n", "- item\n", "<p>x</p>", "?!? ", "é", "# Title\n"]), max_size=120).map("".join), limit=st.integers(6, 40), overlap=st.integers(0, 5))
def test_pieces_join_to_the_text(t, limit, overlap):
    tokens = re.findall(TOKEN_PY, t)
    out = []
    for k, (a, b, n) in enumerate(splitting.split_text(t, limit, overlap)):
        got = re.findall(TOKEN_PY, t[a:b])
        assert len(got) == n and (n <= limit or len(tokens) <= limit)
        keep = 0 if k == 0 else min(overlap, len(out))
        assert got[:keep] == out[len(out) - keep :]
        out += got[keep:]
    assert out == tokens


def test_pieces_end_at_boundaries(spark):
    text = "\n\n".join(f"Paragraph {i} " + "word " * 30 + "end." for i in range(20))
    df = spark.createDataFrame([(1, text, 0), (2, "short", 0), (3, None, 0), (4, "", 0), (5, "x" * 5000, 0), (6, "a " * 500, 0)], "doc_id long, text string, piece int")
    rows = splitting.split_documents(df, limit=100, overlap=10).orderBy("doc_id", "piece").collect()
    assert {r.doc_id for r in rows} == {1, 6}
    assert all(r.piece_text.rstrip().endswith("end.") for r in rows if r.doc_id == 1)
    assert all(r.n_tokens <= 100 for r in rows) and [r.n_pieces for r in rows if r.doc_id == 6] == [6] * 6
    with pytest.raises(ValueError):
        splitting.split_documents(df, limit=10, overlap=10)


@pytest.mark.parametrize("change", [False, True])
def test_copies_of_a_leak_do_not_weaken_it(spark, change):
    """65% of an item in a third of all documents, copied exactly or with a changed word each; a template stays out."""
    item = [f"w{i}" for i in range(60)]
    form = [f"t{i}" if i % 12 < 10 else f"slot{i}" for i in range(60)]
    docs = []
    for n in range(900):
        own = [f"o{n}x{i}" for i in range(20)]
        part = item[:39]
        if change:
            part[n % 39] = f"c{n}"
        other = [w if w[0] == "t" else f"{w}n{n}" for w in form]
        docs.append((n, " ".join(own + (part if n < 300 else other if n < 600 else own) + own[::-1])))
    got = leakage.leaks(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame([(1, " ".join(item)), (2, " ".join(form))], "item_id int, text string"))
    found = {(r.item_id, r.doc_id) for r in got.collect()}
    assert found == {(1, n) for n in range(300)}


def test_class_of_a_row_without_delivery_time(spark):
    rows = [("1", "one two three four five six", None, "g"), ("2", "one two three four five six", 1, "g"), ("2", "seven eight nine ten eleven twelve", None, "g")]
    df = spark.createDataFrame(rows, "id string, text string, at int, g string")
    got = {r.id: r.cls for r in neardup.members(df, id="id", text="text", group=["g"], width=3, order="at").collect()}
    assert got["1"] is not None and got["1"] == got["2"]


def pieces_of(text, limit, overlap):
    return [text[a:b] for a, b, _ in splitting.split_text(text, limit, overlap)]


def test_a_chapter_that_fits_is_not_cut():
    words = lambda k, n: " ".join(f"{k}{i}" for i in range(n))
    chapter = lambda k: f"# Chapter {k}\n\n## {k} one\n\n{words(k + 'x', 160)}\n\n## {k} two\n\n{words(k + 'y', 315)}\n\n"
    first, second = pieces_of(chapter("A") + chapter("B"), 800, 80)
    assert first == chapter("A").rstrip() and second.count("# Chapter B") == 1


def test_nested_lists_are_cut_between_outer_items():
    item = lambda k: f"- item {k}\n" + "".join(f"    - inner {k} {j}\n" for j in range(8))
    parts = pieces_of("".join(item(k) for k in range(6)), 90, 0)
    assert all(p.startswith("- item") for p in parts) and len(parts) > 1
    element = lambda k: f"<div><p>{k} one two</p><p>{k} three four</p></div>\n"
    assert all(p.startswith("<div>") for p in pieces_of("".join(element(k) for k in range(30)), 60, 0))


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.sampled_from(["word ", "two words. ", "\n\n", "\nHEADING LINE\n", "\n- item ", "\n  - inner ", "<div>", "</div>", "<p>x</p>", "\n# Title\n", "\n## Sub\n", "a, b; "]), max_size=150).map("".join),
    st.integers(8, 40), st.integers(0, 5),
)
def test_no_node_that_fits_is_cut(t, limit, overlap):
    """Of the intervals between boundaries of a level and the smaller ones: none within the limit has a cut inside."""
    starts = [m.start() for m in re.finditer(TOKEN_PY, t)]
    if len(starts) <= limit:
        return
    cuts = splitting.cut_points(t, starts, limit, overlap)
    marks = {}
    for place, level in splitting.boundaries(t):
        k = sum(s < place for s in starts)
        marks[k] = min(level, marks.get(k, level))
    for level in set(marks.values()):
        edges = sorted({0, len(starts), *[k for k, m in marks.items() if m <= level]})
        for a, z in zip(edges, edges[1:]):
            if z - a <= limit - overlap:
                assert not any(a < c < z for c in cuts)


def test_ambiguous_names_keep_their_sound_links(spark):
    """A name without a kind of business, near two kinds, isn't linked to either, but to its own spellings."""
    rows = [(n,) for n in ("Vurkartonum Pharma", "Vurkartonum Labs", "Vurkartonum Inc", "Vurkartonumm Inc")]
    got = {r.name: r.entity for r in names.link_names(spark.createDataFrame(rows, "name string")).collect()}
    assert got["Vurkartonum Inc"] == got["Vurkartonumm Inc"] and len(set(got.values())) == 3


def test_ranks_beyond_the_vocabulary_held(spark, monkeypatch):
    """With a small vocabulary in the tasks the rare words' ranks come by a join: words of one frequency share a rank."""
    rnd = random.Random(3)
    texts = [(i, " ".join(rnd.choice(["the", "of", f"w{rnd.randrange(60)}", f"r{rnd.randrange(400)}"]) for _ in range(40)) + (" <b>of</b>" if i % 5 else "")) for i in range(60)]
    df = spark.createDataFrame(texts, "id long, text string")
    anchors = spark.createDataFrame([("plain", "the of the of the. the of the."), ("expert", "r1 r2 r3 r4 r5 w1 w2 r6 r7")], "band string, text string")
    monkeypatch.setattr(reading, "RANKS", 10)
    got = {r.id: r.coverage_rank for r in reading.reading_levels(df, ["id"], "text", anchors).collect()}
    tokens = {i: re.findall(r"[^\W_]+", re.sub("<[^<>]*>", " ", t)) for i, t in texts}
    n = collections.Counter(w for ws in tokens.values() for w in ws)
    top = {w: k + 1 for k, (w, _) in enumerate(sorted(n.items(), key=lambda x: (-x[1], x[0])))}
    for i, ws in tokens.items():
        word = sorted(ws, key=lambda w: top[w])[-(-len(ws) // 2) - 1]
        want = top[word] if top[word] <= 10 else sum(c >= n[word] for c in n.values())
        assert got[i] == want, (i, word)
    assert max(got.values()) > 10


def test_latest_delivery_decides(spark):
    """An id whose latest text is too short, or null, has no class, whatever came before."""
    long = " ".join(f"w{i}" for i in range(30))
    rows = [("a", long, 1), ("a", "short", 2), ("b", long, 2), ("b", "short", 1), ("c", long, 1), ("d", long, 1), ("d", None, 2)]
    who = neardup.members(spark.createDataFrame(rows, "id string, text string, at int"), "id", "text", [], "at")
    assert {r.id for r in who.collect()} == {"b", "c"}


def test_report_of_the_mix(spark):
    docs = spark.createDataFrame([(i, "a b c d", "x" if i % 3 else "y") for i in range(300)], "doc_id long, text string, source string")
    targets = spark.createDataFrame([("x", 0.4, 2), ("y", 0.5, 1), ("z", 0.1, 3)], "source string, target_share double, max_repeats int")
    got = {r.source: r for r in mixing.mix_report(docs, targets).collect()}
    assert all(r.fitting for r in got.values())
    assert {k: r.short for k, r in got.items()} == {"x": False, "y": True, "z": True}
    assert (got["y"].reached, got["z"].reached) == (400, 0) and abs(got["x"].reached - 0.4 * 1200) <= 4


@pytest.mark.parametrize("block", [1, 3, 7])
def test_hot_variant_is_split_without_loss(spark, block):
    """A variant that many unlike classes share is cut into blocks; every pair still meets."""
    rows = [(c, 0, 0, v, n) for v, n in ((1, 20), (2, 5), (3, 2)) for c in range(n)]
    df = spark.createDataFrame(rows, "cls long, s0 long, s1 long, v long, k long")
    got = sorted((r.x, r.y) for r in neardup._meet(df, 0.8, block).collect())
    assert got == list(itertools.combinations(range(20), 2))


def test_short_forms_are_learnt(spark):
    """Words outside the fixed lists: short forms beside the same companies are learnt and hold for others too."""
    heads = ["Agelven", "Bupenleeth", "Kellertoand", "Neltenron", "Wexcombe"]
    rows = [f"{h} {k}" for h in heads for k in ("Nutritionals", "Nutr.", "Packaging Inc", "Pkg", "Marketing")] + ["Vurkartonum Nutritionals", "Vurkartonum Nutr", "Vurkartonum Mktg"]
    # Names of few companies beside words of many teach nothing, whatever they look like.
    rows += [f"{h} {k}" for h in ("Sunlight", "Sun") for k in ("Nutritionals", "Packaging", "Marketing", "Foods")] + [f"{h} Mktg" for h in heads[:3]] + ["!!", "x " * 5000]
    got = {r.name: r.entity for r in names.link_names(spark.createDataFrame([(r,) for r in rows], "name string")).collect()}
    assert len(got) == len(set(rows))
    for h in [*heads, "Vurkartonum"]:
        assert got[f"{h} Nutritionals"] == got.get(f"{h} Nutr.", got.get(f"{h} Nutr"))
    assert got["Wexcombe Packaging Inc"] == got["Wexcombe Pkg"] and got["Agelven Marketing"] == got["Agelven Mktg"]
    assert got["Agelven Nutr."] != got["Bupenleeth Nutr."] and got["Agelven Nutr."] != got["Agelven Pkg"]
    assert got["Sun Nutritionals"] != got["Sunlight Nutritionals"]
    empty = names.learn_abbreviations(spark.createDataFrame([], "words array<string>"))
    assert empty.count() == 0


def test_distances_of_many_words(monkeypatch):
    """The batched distances are those taken one by one, for empty and long words too."""
    rnd = random.Random(4)
    draw = lambda n: ["".join(rnd.choice("abc") for _ in range(rnd.randrange(0, 9))) for _ in range(n)]
    monkeypatch.setattr(names, "LETTERS", 7)
    monkeypatch.setattr(names, "CHUNK", 50)
    words, points = [*draw(400), "", "ca", "abc" * 9], [*draw(12), "", "abc", "bca" * 9]
    assert names.distances(words, points).tolist() == [[names.distance(w, p) for p in points] for w in words]
