"""Operators against brute force and edge cases."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labelmill.operators import history, metrics, nested, upsert
from labelmill.operators import hierarchy as H
from labelmill.operators.strength import equal_but_written_differently, with_common_units


def says(v):
    while isinstance(v, str):
        try:
            v = json.loads(v)
        except ValueError:
            return None
    return v


def brute_nested(key, raw):
    out = set()

    def walk(v, path, parent, listed, pos):
        v = says(v)
        if isinstance(v, dict):
            if listed:
                path += "[0]" if pos is None else ""
                out.add((key, path, parent))
                parent = path
            for k, x in v.items():
                walk(x, f"{path}.{k}" if path else k, parent, k in nested.RECORD_LISTS, None)
        elif isinstance(v, list):
            for i, x in enumerate(v):
                walk(x, f"{path}[{i}]", parent, listed and pos is None, i)

    try:
        top = json.loads(raw)
    except (TypeError, ValueError):
        return out
    walk(top, "", "", False, None)
    return out


def deep(n):
    v = {"name": "x"}
    for _ in range(n):
        v = {"assigned": [None, v]}
    return json.dumps(v)


NESTED = [
    ("null", None), ("blank", ""), ("bad", '{"packages": [{"a": 1}'), ("list", "[]"), ("scalar", "3"), ("lone", '{"products": {"name": "x", "packages": {"form": "y"}}}'),
    ("text", '{"products": "[{\\"name\\": \\"x\\", \\"media\\": [null, {}]}]"}'), ("double", json.dumps(json.dumps({"media": [{"a": []}]}))), ("deep", deep(30)),
    ("lists", '{"media": [[{"a": 1}], {"b": {"media": [1, "x", {"c": 2}]}}]}'), ("looks", '{"media": ["{not json", "[1", {"x": "\\"q\\""}]}'), ("same", '{"media": [{}]}'), ("same", '{"media": [{}]}'),
]


def test_nested_records(spark):
    df = spark.createDataFrame([(k, v, 1, "z") for k, v in NESTED], "k string, js string, path int, record string")
    got = [tuple(r) for r in nested.nested_records(df, "k", "js").select("k", "node_path", "parent_path").collect()]
    want = set().union(*[brute_nested(k, v) for k, v in NESTED])
    assert set(got) == want
    assert len(got) == len(want) + 1  # the repeated row
    assert max(len(p) for _, p, _ in got) > 300


def test_nested_tables(spark):
    """Every field comes out: in its column, or in ``more``."""
    js = """{"products": {"name": "p", "form": {"code": "C1", "display_name": "TABLET"}, "odd": [1], "packages": [{"quantity": 2, "form": "BOX", "contents": {"ndc": "1"}}],
      "ingredients": [{"name": "i", "class": null, "quantity": {"numerator": {"value": 392, "unit": "mg"}, "denominator": {"value": 1}}},
        {"name": {"x": 1}, "quantity": {"numerator": {"value": 3, "unit": "mg"}, "note": "about"}, "moieties": "none"}]}}"""
    rounds = nested.nested_projection(spark.createDataFrame([("a", js)], "k string, js string"), "k", "js")
    table = lambda r: nested.record_table(rounds, "k", r).orderBy("node_path").collect()
    (p,) = table("products")
    assert (p.name, p.form_code, p.form_display_name, json.loads(p.more)) == ("p", "C1", "TABLET", {"odd": [1]})
    (box,) = table("packages")
    assert (box.node_path, box.parent_path, box.quantity, box.form, box.ndc, box.more) == ("products[0].packages[0]", "products[0]", 2.0, "BOX", None, None)
    (inner,) = table("contents")
    assert (inner.parent_path, inner.ndc) == ("products[0].packages[0]", "1")
    one, two = table("ingredients")
    assert (one.numerator_value, one.numerator_unit, one.denominator_value, one.denominator_unit, one.more) == (392.0, "mg", 1.0, None, None)
    assert (two.name, two.numerator_value, json.loads(two.more)) == ('{"x":1}', 3.0, {"moieties": "none", "quantity": {"note": "about", "numerator": {"unit": "mg", "value": 3}}})


def test_nested_empty(spark):
    assert nested.nested_records(spark.createDataFrame([], "k string, js string"), "k", "js").count() == 0


def brute_tree(parent):
    out = {}
    for i in parent:
        seen, at, n = set(), i, 0
        while parent[at] in parent and at not in seen:
            seen.add(at)
            at, n = parent[at], n + 1
        out[i] = ("cycle", -1) if at in seen else (at, n)
    return out


@pytest.mark.parametrize("fragment_rows", [2, 7, 1000])
def test_hierarchy(spark, fragment_rows):
    rnd = random.Random(fragment_rows)
    parent = {f"n{i}": rnd.choice([None, "nowhere", *[f"n{rnd.randrange(60)}"] * 4]) for i in range(60)}
    parent |= {f"c{i}": f"c{i - 1}" for i in range(1, 40)} | {"c0": None, "self": "self"}
    rows = [(i, p, f"g{hash(i) % 3}", 1) for i, p in parent.items()] + [(None, "n1", "g0", 1), ("n3", parent["n3"], "g0", 2)]
    df = spark.createDataFrame(rows, "id string, parent string, spl string, depth int")
    got = {r.id: (r.root_id, r.depth) for r in H.hierarchy(df, "id", "parent", "spl", fragment_rows).collect()}
    assert got == brute_tree(parent)


@pytest.mark.parametrize("fragment_rows", [6, 1000])
def test_paths(spark, fragment_rows):
    """Paths, places, descendants over fragments and quotients, against walking up the parents."""
    rnd = random.Random(5)
    parent = {f"n{i}": rnd.choice([None, "gone", *[f"n{rnd.randrange(i)}"] * 8]) if i else None for i in range(50)}
    parent |= {f"c{i}": f"c{i - 1}" for i in range(1, 30)} | {"c0": "n7", "self": "self", "loop": "pool", "pool": "loop", "under": "pool"}
    place = {i: rnd.choice([None, rnd.randrange(9)]) for i in parent}
    df = spark.createDataFrame([(i, p, f"g{len(i)}", place[i], "x") for i, p in parent.items()], "id string, parent string, spl string, o int, path string")
    want = {}
    for i in parent:
        way = [i]
        while parent[way[0]] in parent and len(way) < 100:
            way.insert(0, parent[way[0]])
        if len(way) < 100:
            want[i] = way
    got = {r.id: r for r in H.hierarchy_paths(df, "id", "parent", "o", "spl", fragment_rows).collect()}
    assert {i: (list(r.path), r.depth, r.root_id) for i, r in got.items()} == {i: (w, len(w) - 1, w[0]) for i, w in want.items()}
    assert all(list(r.order_path) == [2**62 if place[x] is None else place[x] for x in want[i]] for i, r in got.items())
    assert all(r.n_descendants == sum(i in w[:-1] for w in want.values()) for i, r in got.items())
    pairs = {(r.id, r.ancestor_id, r.distance) for r in H.ancestors(H.node_paths(df, "id", "parent", "o", "spl", fragment_rows)).collect()}
    assert pairs == {(i, a, len(w) - 1 - k) for i, w in want.items() for k, a in enumerate(w)}


def test_hierarchy_empty_and_chain(spark):
    assert H.hierarchy(spark.createDataFrame([], "id string, parent string"), "id", "parent").count() == 0
    chain = spark.createDataFrame([(f"{i}", f"{i - 1}" if i else None) for i in range(300)], "id string, parent string")
    assert H.hierarchy_paths(spark.createDataFrame([], "id string, parent string, o int"), "id", "parent", "o").count() == 0
    assert H.hierarchy(chain, "id", "parent", fragment_rows=10).agg(F.max("depth")).first()[0] == 299


def test_paths_and_descendants(spark):
    rows = [("r", None, 1), ("a", "r", 2), ("b", "r", None), ("c", "a", 1), ("x", "y", 1), ("y", "x", 1)]
    df = spark.createDataFrame(rows, "id string, parent string, o int")
    got = {r.id: r for r in H.hierarchy_paths(df, "id", "parent", "o").collect()}
    assert set(got) == {"r", "a", "b", "c"}
    assert got["c"].path == ["r", "a", "c"] and got["c"].order_path == [1, 2, 1]
    assert (got["r"].n_descendants, got["a"].n_descendants, got["c"].depth, got["c"].root_id) == (3, 1, 2, "r")


def test_history(spark):
    schema = "k string, v int, d string, x int"
    first = spark.createDataFrame([("a", 1, "2020", None), ("a", 2, "2021", 1), ("b", 1, None, 1)], schema)
    second = spark.createDataFrame([("a", 1, "2020", None), ("a", 2, "2022", 1), ("b", 1, None, 1), ("c", 1, "2023", 2)], schema)
    got = history.snapshot_history([("s0", first), ("s1", second), ("s2", second)], ["k", "v"], ["d", "x"])
    rows = sorted((r.k, r.v, r.d or "", r.recorded_at, r.is_current) for r in got.collect())
    assert rows == [("a", 1, "2020", "s0", True), ("a", 2, "2021", "s0", False), ("a", 2, "2022", "s1", True), ("b", 1, "", "s0", True), ("c", 1, "2023", "s1", True)]


def test_merkle_finds_only_differing_leaves(spark):
    a = spark.range(500).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("x"))
    b = a.withColumn("x", F.when(F.col("k") == "7", 2).otherwise(1))
    leaves = history.differing_leaves(history.merkle_levels(a, ["k"], ["x"]), history.merkle_levels(b, ["k"], ["x"]))
    want = a.where("k = '7'").select(history._leaf(["k"]).alias("n")).first().n
    assert [r.node for r in leaves.collect()] == [want]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(1, 5), st.integers(1, 9)), unique_by=lambda r: r[:2], max_size=8))
def test_periods(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int, d int")
    got = {(r.k, r.v): (r.valid_from, r.valid_to) for r in history.periods_in_force(df, "k", "v", "d").collect()}
    for day in range(0, 12):
        for k in "ab":
            ruling = max((v for kk, v, d in rows if kk == k and d <= day), default=None)
            assert [v for (kk, v), (a, b) in got.items() if kk == k and a <= day and (b is None or day < b)] == ([ruling] if ruling else [])


def test_equal_strengths(spark):
    rows = [
        ("1", "u", "500.000000", "mg", None, None), ("2", "u", "0.500000", "g", "1.000000", "tablet"), ("3", "u", "500.000000", "mg", None, None), ("4", "u", "501.0", "mg", None, None),
        ("5", "u", None, "500 mg/tab", None, None), ("6", None, "500.000000", "mg", None, None), ("7", "u", None, "q.s.", None, None), ("8", "w", "0.0", "mg", None, None), ("9", "w", "0.0", "g", None, None),
    ]
    cols = ["strength_numerator", "strength_numerator_unit", "strength_denominator", "strength_denominator_unit"]
    df = spark.createDataFrame(rows, "id string, u string, " + ", ".join(f"{c} string" for c in cols))
    df = df.withColumns({c: F.lit("x") for c in ("v", "b", "_q", "value", "kind", "a")})
    got = {tuple(r) for r in equal_but_written_differently(with_common_units(df), ["u"], "id", cols).collect()}
    assert got == {("1", "2"), ("2", "3"), ("1", "5"), ("3", "5"), ("2", "5"), ("8", "9")}
    assert equal_but_written_differently(with_common_units(df.limit(0)), ["u"], "id", cols).count() == 0


def test_upsert_and_versions(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, at int, v string")
    new = spark.createDataFrame([("a", 2, "z", 9), ("c", 1, "w", 9), ("b", 0, "late", 9)], "k string, at int, v string, extra int")
    got = {r.k: (r.at, r.v, r.extra) for r in upsert.upsert(old, new, ["k"], "at").collect()}
    assert got == {"a": (2, "z", 9), "b": (1, "y", None), "c": (1, "w", 9)}
    assert {(r.k, r.v) for r in upsert.replace_children(old, new.select("k", "at", "v").where("k = 'a'"), "k").collect()} == {("a", "z"), ("b", "y")}
    assert upsert.delete_documents({"t": old}, old.where("k = 'a'"), "k")["t"].count() == 1
    changed = upsert.changes(spark.createDataFrame([("a", 1, None), ("a", 2, None), ("a", 3, "x")], "k string, o int, v string"), "k", ["o"], ["v"])
    assert [r.is_changed for r in changed.orderBy("o").collect()] == [True, False, True]
    assert upsert.key_collisions(spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int"), "k", ["v"]).collect()[0].k == "a"


def test_metrics_of_empty_tables(spark):
    empty = spark.createDataFrame([], "ok boolean, s double, size bigint, at timestamp, e string")
    assert tuple(metrics.catalog_stats(empty, "size", "at").first()) == (0, 0, None)
    assert metrics.batch_stats(empty, "ok", "s").first().success_rate == 0.0
    assert metrics.top_errors(empty, "e").count() == 0


def test_every_delivered_state_is_a_version(spark):
    """Also one that is corrected, or taken back, between two cuts."""
    rows = [(f"k{i}", 1, "x", f"2020-01-{i % 28 + 1:02d} 00:00:00") for i in range(56)]
    rows += [("a", 1, v, f"2020-01-15 00:00:{s:02d}") for s, v in enumerate(["A", "B", "B", "A", None, "C"])]
    rows += [("b", 1, "A", "2020-01-01 00:00:00"), ("b", 1, "B", "2020-01-27 00:00:00"), ("b", 1, "A", "2020-01-28 00:00:00")]
    rows += [("c", 1, "late", "2020-01-20 00:00:00"), ("c", 1, "first", None), (None, 1, "no", "2020-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "k string, v int, d string, at string")
    got = history.delivered_history(df, ["k", "v"], ["d"], "at").orderBy("k", F.col("delivered_at").asc_nulls_first()).collect()
    seen = lambda k: [(r.d, r.is_current) for r in got if r.k == k]
    assert seen("a") == [("A", False), ("B", False), ("A", False), (None, False), ("C", True)]
    assert seen("b") == [("A", False), ("B", False), ("A", True)]
    assert seen("c") == [("first", False), ("late", True)]
    assert all(seen(f"k{i}") == [("x", True)] for i in range(56)) and len(got) == 66
