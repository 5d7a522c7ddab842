"""Deeply nested semi-structured records into flat tables with parent-child links.

A document is parsed once, to a VARIANT. Every level is one higher-order projection: ``transform``
visits the nodes of a level and attaches the path of the nearest enclosing record and the position
in its list, ``flatten`` joins the levels' arrays, and one ``inline`` per target table emits its
rows. A round projects ``LEVELS`` levels; documents that are deeper go through further rounds, so
there is no depth limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.session import materialize

#: Names of the lists whose objects are records.
RECORD_LISTS = (
    "organizations", "assigned", "operations", "products", "packages", "contents", "ingredients", "moieties", "media",
)
#: Levels of JSON containers projected in one round (a list and its objects are two levels).
LEVELS = 10
#: Columns of the flat tables: column -> (path in the record, type). An object that isn't a record is flattened into its columns.
TABLES = {
    "organizations": {"name": ("name", "string"), "id_root": ("id_root", "string"), "id_extension": ("id_extension", "string")},
    "assigned": {"name": ("name", "string"), "id_root": ("id_root", "string"), "id_extension": ("id_extension", "string")},
    "operations": {"code": ("code", "string"), "display_name": ("display_name", "string")},
    "products": {"name": ("name", "string"), "form_code": ("form.code", "string"), "form_display_name": ("form.display_name", "string")},
    "packages": {"quantity": ("quantity", "double"), "form": ("form", "string"), "ndc": ("ndc", "string")},
    "contents": {"quantity": ("quantity", "double"), "form": ("form", "string"), "ndc": ("ndc", "string")},
    "ingredients": {
        "name": ("name", "string"), "class": ("class", "string"),
        "numerator_value": ("quantity.numerator.value", "double"), "numerator_unit": ("quantity.numerator.unit", "string"),
        "denominator_value": ("quantity.denominator.value", "double"), "denominator_unit": ("quantity.denominator.unit", "string"),
    },
    "moieties": {"name": ("name", "string"), "unii": ("unii", "string")},
    "media": {"media_id": ("media_id", "string"), "reference_value": ("reference_value", "string")},
}


def _node(path: str, parent: str, name: str, pos: str, listed: str, value: str) -> str:
    """SQL of a node: an object has ``m``, a list ``a``, a text ``t``; other values have none of them."""
    first = f"named_struct('m', try_variant_get(v, '$', 'map<string,variant>'), 'a', try_variant_get(v, '$', 'array<variant>'), 'v', v)"
    return f"""transform(transform(array({value}), v -> {first}), o -> named_struct('path', {path}, 'parent', {parent}, 'name', {name},
        'pos', cast({pos} AS int), 'listed', {listed}, 'm', o.m, 'a', o.a,
        't', CASE WHEN o.m IS NULL AND o.a IS NULL THEN try_variant_get(o.v, '$', 'string') END))[0]"""


#: A field of an object as JSON whose value isn't null or an object.
_VALUE = r'"(?:[^"\\\\]|\\\\.)*":(?!null|[{])'
_IS_NODE = "n -> n.m IS NOT NULL OR n.a IS NOT NULL OR substring(ltrim(n.t), 1, 1) IN ('{', '[', '\"')"


def _step(nodes: str, names: tuple[str, ...]) -> str:
    """SQL of the nodes one level below the column ``nodes``.

    A lone object under a record name is position 0 of its list. Lists within a list are walked,
    but what stands in them isn't in the record list itself. A text is a level above what it says.
    """
    among = ", ".join(f"'{n}'" for n in names)
    field = _node(
        "concat(h.here, CASE WHEN h.here = '' THEN '' ELSE '.' END, e.key)", "h.parent", "e.key", "NULL", f"e.key IN ({among})", "e.value"
    )
    item = _node("concat(n.path, '[', i, ']')", "n.parent", "n.name", "i", "n.listed AND n.pos IS NULL", "x")
    text = _node("n.path", "n.parent", "n.name", "n.pos", "n.listed", "try_parse_json(n.t)")
    here = "concat(n.path, CASE WHEN n.listed AND n.pos IS NULL THEN '[0]' ELSE '' END)"
    return f"""filter(flatten(transform({nodes}, n -> CASE
        WHEN n.m IS NOT NULL THEN flatten(transform(array(named_struct('here', {here}, 'parent', CASE WHEN n.listed THEN {here} ELSE n.parent END)),
            h -> transform(map_entries(n.m), e -> {field})))
        WHEN n.a IS NOT NULL THEN transform(n.a, (x, i) -> {item})
        ELSE array({text}) END)), {_IS_NODE})"""


_RECORD = "named_struct('record', n.name, 'node_path', CASE WHEN n.pos IS NULL THEN concat(n.path, '[0]') ELSE n.path END, 'parent_path', n.parent, 'pos', coalesce(n.pos, 0), 'fields', n.m)"


def nested_projection(df: DataFrame, key: str, json_column: str, names: tuple[str, ...] = RECORD_LISTS) -> list[DataFrame]:
    """The records of every document as arrays, written once: key, records; one table per round of ``LEVELS`` levels.

    Rules: null, blank or invalid JSON holds no record (JSON that repeats a field within an object
    is invalid); nulls in a list keep their position but are no record; a lone object stands at
    position 0; a text that is JSON counts as what it says; keys may repeat (each row is a document
    of its own). The result's own columns are struct fields until a table is emitted, so no column
    of ``df`` can clash with them; other columns are left out.
    """
    top = _node("''", "''", "''", "NULL", "false", "d")
    level = df.select(F.col(key), F.expr(f"try_parse_json(cast(`{json_column}` AS string))").alias("_d"))
    level = level.select(key, F.expr(f"filter(transform(array(_d), d -> {top}), {_IS_NODE})").alias("_l0")).where(F.size("_l0") > 0)
    rounds = []
    while True:
        for k in range(LEVELS):
            level = level.withColumn(f"_l{k + 1}", F.expr(_step(f"_l{k}", names)))
        records = ", ".join(f"transform(filter(_l{k + 1}, n -> n.listed AND n.m IS NOT NULL), n -> {_RECORD})" for k in range(LEVELS))
        done = materialize(level.select(key, F.expr(f"flatten(array({records}))").alias("_records"), F.col(f"_l{LEVELS}").alias("_l0")))
        rounds.append(done.select(key, "_records"))
        level = done.where(F.size("_l0") > 0).select(key, "_l0")
        if level.isEmpty():
            return rounds


def _emitted(rounds: list[DataFrame], key: str, keep: str = "") -> DataFrame:
    """The rows of one target table: one ``inline`` over its records."""
    out = None
    for part in rounds:
        records = F.expr(f"filter(_records, r -> r.record = '{keep}')") if keep else F.col("_records")
        rows = part.select(key, F.inline(records))
        out = rows if out is None else out.unionByName(rows)
    return out


def nested_records(df: DataFrame, key: str, json_column: str, names: tuple[str, ...] = RECORD_LISTS) -> DataFrame:
    """One row per object in a list named in ``names``, at any depth of ``json_column``.

    Returns ``key, record, node_path, parent_path, pos, fields``: the name of the list, the path of
    the object, the path of the nearest record around it ('' at the top), the position in the list
    and the object's fields. See :func:`nested_projection` for the rules.
    """
    return _emitted(nested_projection(df, key, json_column, names), key)


def record_table(rounds: list[DataFrame], key: str, record: str, columns: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """The flat table of one record name from :func:`nested_projection`.

    key, node_path, parent_path, pos, the record's columns, and ``more``: the JSON of the fields
    that are neither columns nor records of their own, null if there are none, so nothing is lost.
    A field of another type than its column's is null there and kept in ``more``; a field that is
    absent and one that is null are both null.
    """
    columns = columns or TABLES[record]
    rows = _emitted(rounds, key, record)
    tops: dict[str, list[str]] = {}
    got = {}
    for name, (path, kind) in columns.items():
        top, _, below = path.partition(".")
        inner = "".join(f".{p}" for p in [below] if p)
        got[name] = F.expr(f"try_variant_get(fields['{top}'], '${inner}', '{kind}')")
        tops.setdefault(top, []).append(name)
    among = ", ".join(f"'{r}'" for r in RECORD_LISTS)
    cases = []
    for top, names in tops.items():
        filled = " + ".join(f"CASE WHEN r.`{n}` IS NULL THEN 0 ELSE 1 END" for n in names)
        # A flattened object is read if it has no more values than its filled columns.
        values = f"""regexp_count(to_json(v), '{_VALUE}')""" if "." in columns[names[0]][0] else "1"
        cases.append(f"WHEN k = '{top}' THEN {values} > {filled}")
    unread = " ".join(cases)
    read = F.struct(*[c.alias(n) for n, c in got.items()])
    rest = F.expr(
        f"""transform(array(_r), r -> map_filter(fields, (k, v) -> NOT is_variant_null(v) AND CASE {unread} WHEN k IN ({among})
            THEN try_variant_get(v, '$', 'map<string,variant>') IS NULL AND try_variant_get(v, '$', 'array<variant>') IS NULL ELSE true END))[0]"""
    )
    out = rows.withColumn("_r", read).withColumn("_more", rest)
    return out.select(key, "node_path", "parent_path", "pos", "_r.*", F.when(F.size("_more") > 0, F.to_json("_more")).alias("more"))
