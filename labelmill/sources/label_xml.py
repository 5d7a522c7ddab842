"""Label documents as a source: loose XML files, nested archives, and a writer for round trips."""

from __future__ import annotations

import html
import io
import re
import zipfile
from collections.abc import Iterator
from functools import reduce
from itertools import batched
from math import inf

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Section levels unrolled in the schema; deeper ones are cut out of the text by ``cut_sections`` and parsed with the same schema.
DEPTH = 6
#: Bytes above which a label's sections aren't parsed with it, but cut out and parsed one by one: parsed as one value a label takes many times its text.
LARGE = 1_000_000
#: Signs of a document in which its root is looked for first.
BEGINNING = 10_000
NAMESPACE = "urn:hl7-org:v3"
# Identifiers of code systems.
SYSTEMS = {"ndc": "2.16.840.1.113883.6.69", "unii": "2.16.840.1.113883.4.9", "loinc": "2.16.840.1.113883.6.1"}
_CODE = "struct<_code:string,_codeSystem:string,_displayName:string>"
_NUMBER = "struct<_value:string,_unit:string>"
_NAME = "struct<_VALUE:string,suffix:string>"
_SUBSTANCE = f"struct<code:{_CODE},name:string,activeMoiety:struct<activeMoiety:struct<code:{_CODE},name:string>>>"
_INGREDIENT = f"struct<_classCode:string,quantity:struct<numerator:{_NUMBER},denominator:{_NUMBER}>,ingredientSubstance:{_SUBSTANCE}>"
_CONTENT = f"struct<quantity:struct<numerator:{_NUMBER},denominator:{_NUMBER}>,containerPackagedProduct:struct<code:{_CODE},formCode:{_CODE}>>"
_INNER = (
    f"struct<code:{_CODE},name:{_NAME},formCode:{_CODE},asEntityWithGeneric:struct<genericMedicine:struct<name:string>>,"
    f"ingredient:array<{_INGREDIENT}>,asContent:array<{_CONTENT}>>"
)
_ACT = f"struct<code:{_CODE},statusCode:struct<_code:string>,effectiveTime:struct<low:struct<_value:string>,high:struct<_value:string>>>"
_APPROVAL = (
    f"struct<id:struct<_extension:string>,code:{_CODE},author:struct<territorialAuthority:struct<territory:struct<code:struct<_code:string>>>>>"
)
_PRODUCT = (
    f"struct<manufacturedProduct:{_INNER},subjectOf:array<struct<approval:{_APPROVAL},marketingAct:{_ACT}>>,"
    f"consumedIn:array<struct<substanceAdministration:struct<routeCode:{_CODE}>>>>"
)
_MEDIA = "struct<_ID:string,text:string,value:struct<_mediaType:string,reference:struct<_value:string>>>"


def _section(level: int) -> str:
    below = "string" if level == 0 else _section(level - 1)
    return (
        f"struct<_ID:string,id:struct<_root:string>,code:{_CODE},title:string,text:string,effectiveTime:struct<_value:string>,"
        f"subject:array<struct<manufacturedProduct:{_PRODUCT}>>,component:array<struct<section:{below},observationMedia:{_MEDIA}>>>"
    )


_ORGANIZATION = "struct<id:struct<_extension:string,_root:string>,name:string>"
_BODY = f"struct<component:array<struct<section:{_section(DEPTH - 1)}>>>"
_HEADER = (
    f"id struct<_root:string>, code {_CODE}, title string, effectiveTime struct<_value:string>, setId struct<_root:string>, "
    f"versionNumber struct<_value:string>, author struct<time:struct<_value:string>,assignedEntity:struct<representedOrganization:"
    f"struct<id:struct<_extension:string,_root:string>,name:string,assignedEntity:array<struct<assignedOrganization:array<{_ORGANIZATION}>>>>>>"
)
DOCUMENT = f"{_HEADER}, component struct<structuredBody:{_BODY}>, _corrupt_record string"
#: A document of which the parser passes over all that stands in the body.
_HEAD = f"{_HEADER}, component struct<structuredBody:struct<_ID:string>>, _corrupt_record string"


def read_xml_dir(spark: SparkSession, path: str, recursive: bool = False, first: int | None = None) -> DataFrame:
    """path, xml: one row per ``*.xml`` file; xml is null where the file isn't UTF-8 text. An empty folder gives no row."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").option("recursiveFileLookup", recursive).load(path)
    out = files.select("path", F.expr("try_validate_utf8(cast(content AS string))").alias("xml"))
    return out if first is None else out.orderBy("path").limit(first)


def read_xml_zip(spark: SparkSession, path: str, glob: str = "*spl_release*.zip") -> DataFrame:
    """archive, category, inner, name, xml of all label files in archives of archives.

    An inner archive counts once by its name (the first by archive and category); bad archives,
    outer or inner, give no row. An archive is opened by one task, inner ones one at a time.
    """
    names = ["archive", "category", "inner", "name", "xml"]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for archive, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    outer = zipfile.ZipFile(io.BytesIO(content))
                except zipfile.BadZipFile:
                    continue
                for inner in sorted(n for n in outer.namelist() if n.lower().endswith(".zip")):
                    try:
                        z = zipfile.ZipFile(io.BytesIO(outer.read(inner)))
                    except (zipfile.BadZipFile, RuntimeError):
                        continue
                    parts = inner.split("/")
                    rows = [
                        (archive, parts[-2] if len(parts) > 1 else "", parts[-1], n, z.read(n).decode("utf-8", "replace"))
                        for n in sorted(z.namelist())
                        if n.lower().endswith(".xml")
                    ]
                    yield pd.DataFrame(rows, columns=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    found = files.mapInPandas(unpack, schema)
    chosen = found.groupBy("inner").agg(F.min(F.struct("archive", "category")).alias("first"))
    kept = chosen.select("inner", F.col("first.archive").alias("archive"), F.col("first.category").alias("category"))
    return found.join(kept, ["inner", "archive", "category"], "left_semi").select(*names)


def is_large(xml: Column) -> Column:
    return F.coalesce(F.octet_length(xml) > F.lit(LARGE), F.lit(False))


def is_deep(xml: Column) -> Column:
    """Whether sections may lie below the schema: a label with fewer sections than levels has none that deep."""
    return F.length(xml) - F.length(F.replace(xml, F.lit("<section"), F.lit(""))) > F.lit(DEPTH * len("<section"))


def is_label(xml: Column, doc: Column) -> Column:
    """Well-formed, root ``document`` of the label namespace, with id, code, set and version."""
    pattern = rf'(?s)^\s*(?:<\?.*?\?>\s*|<!--.*?-->\s*)*<(?:\w+:)?document\b[^>]*"{NAMESPACE}"'
    # Nearly always the beginning tells; a pattern makes a copy of the text it is tried on.
    root = F.substring(xml, 1, BEGINNING).rlike(pattern) | ((F.octet_length(xml) > BEGINNING) & xml.rlike(pattern))
    parts = [doc[c].isNotNull() for c in ("id", "code", "setId", "versionNumber")]
    return F.coalesce(reduce(lambda a, b: a & b, [doc["_corrupt_record"].isNull(), root, *parts]), F.lit(False))


def parse(df: DataFrame, xml: str = "xml") -> DataFrame:
    """Adds doc, the parsed label. Malformed or empty XML keeps its text in doc._corrupt_record.

    The body of a label above ``LARGE`` is left empty here; its sections come from :func:`cut_sections`.
    What is asked of the text later is noted in doc, so that the text itself is only read to be cut:
    ``_there`` (not null), ``_label`` (:func:`is_label`), ``_large``, ``_deep`` (:func:`is_deep`).
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    whole = F.from_xml(F.when(~is_large(F.col(xml)), F.col(xml)), DOCUMENT, options)
    head = F.from_xml(F.when(is_large(F.col(xml)), F.col(xml)), _HEAD, options)
    rows = df.withColumn("doc", whole).withColumn("_head", head)
    h = F.col("_head")
    body = F.when(h["component"]["structuredBody"].isNotNull(), F.struct(F.struct(F.array().cast(f"array<struct<section:{_section(DEPTH - 1)}>>").alias("component")).alias("structuredBody")))
    fields = [c.split(" ", 1)[0] for c in _HEADER.split(", ")]
    large = F.struct(*[h[c].alias(c) for c in fields], body.alias("component"), h["_corrupt_record"].alias("_corrupt_record"))
    rows = rows.withColumn("doc", F.when(h.isNotNull(), large).otherwise(F.col("doc"))).drop("_head")
    x, d = F.col(xml), F.col("doc")
    deep = F.when(~is_large(x), F.coalesce(is_deep(x), F.lit(False))).otherwise(F.lit(False))
    notes = [x.isNotNull().alias("_there"), is_label(x, d).alias("_label"), is_large(x).alias("_large"), deep.alias("_deep")]
    return rows.withColumn("doc", F.struct(*[d[c].alias(c) for c in (*fields, "component", "_corrupt_record")], *notes))


#: Pieces that leave the cutting task at once.
PIECES = 1000
_TOKEN = re.compile(rb"""<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<(/?)([\w:.\x80-\xff-]+)((?:[^>"']|"[^"]*"|'[^']*')*?)(/?)>""", re.S)
_ROOT = re.compile(rb"""\sroot\s*=\s*(?:"([^"]*)"|'([^']*)')""")
_CUT = b'<section ID=""/>'


def fragments(xml: bytes | memoryview, depth: int = DEPTH, least: int = 1, most: float = inf) -> Iterator[tuple[list[int], str | None, str]]:
    """(path, id of the section above, text) of the sections whose depth is a multiple of ``depth``, from ``least`` to ``most``, in one scan.

    A text has an empty section where the next multiple begins: the texts don't overlap and none has
    more than ``depth`` levels. Sections below one without an id are left out. ``xml`` (UTF-8, not copied) must be well-formed.
    """
    # Sections at these depths begin a text.
    begins = lambda d: d >= least and d % depth == 0
    # An open element: [name, is it on the way body/component/section/..., place in the list of components,
    # components so far, section id, section depth, parts of its fragment].
    stack: list[list] = [[b"", False, -1, -1, None, -1, None]]
    writing: list[list[bytes | memoryview]] = []  # open fragments, the innermost last
    last = 0
    for m in _TOKEN.finditer(xml):
        name = (m.group(2) or b"").lower()
        if not name:
            continue
        if not m.group(1):
            up = stack[-1]
            on = name == b"structuredbody" or (up[1] and (name == b"component" and up[0] != b"component" or name == b"section" and up[0] == b"component"))
            here = [name, on, -1, -1, None, up[5], None]
            if on and name == b"component":
                up[3] += 1
                here[2] = up[3]
            elif on and name == b"section":
                here[5] += 1
                if begins(here[5]):
                    if writing:
                        writing[-1] += [xml[last : m.start()], _CUT]
                    last = m.start()
                    writing.append([])
                    above = [e for e in stack if e[0] == b"section" and e[1]]
                    if here[5] <= most and all(e[4] for e in above):
                        here[6] = ([e[2] for e in stack if e[0] == b"component" and e[1]], above[-1][4] if above else None)
            elif name == b"id" and up[0] == b"section" and up[1]:
                found = _ROOT.search(m.group(3))
                up[4] = html.unescape((found.group(1) or found.group(2) or b"").decode()) if found else None
            if not m.group(4):
                stack.append(here)
                continue
        else:
            here = stack.pop()
        if here[1] and here[0] == b"section" and begins(here[5]):
            text = b"".join([*writing.pop(), xml[last : m.end()]]).decode()
            last = m.end()
            if here[6]:
                yield *here[6], text


def large_fragments(labels: DataFrame, most: float = inf) -> DataFrame:
    """document_id, path, parent_section_id, s: the sections of labels above ``LARGE`` down to depth ``most``, parsed."""
    return parse_pieces(cut_sections(labels.where("doc._large"), most))


def subjects(pieces: DataFrame) -> DataFrame:
    """The parsed top-level sections of :func:`cut_sections` that may have subjects; only labels above ``LARGE`` have such pieces."""
    return parse_pieces(pieces.where((F.size("path") == 1) & F.lower("x").contains("subject")))


def cut_sections(labels: DataFrame, most: float = inf) -> DataFrame:
    """document_id, path, parent_section_id, x: see :func:`fragments`; of labels above ``LARGE`` every section down to depth ``most`` is cut out alone.

    ``labels`` has document_id, xml and the doc of :func:`parse`. Spark gives what lies below its schema as text
    without entities, which can't be parsed again; so the sections are cut out of the document's own text.
    """
    kinds = {"document_id": pa.string(), "path": pa.list_(pa.int32()), "parent_section_id": pa.string(), "x": pa.string()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*batch.columns, strict=True)
            pieces = ((i.as_py(), *f) for i, xml, large in rows for f in (fragments(memoryview(xml.as_buffer()), 1, 0, most) if large.as_py() else fragments(memoryview(xml.as_buffer()))))
            for part in batched(pieces, PIECES):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part, strict=True), kinds.values(), strict=True)], names=list(kinds))

    found = labels.where("doc._large or doc._deep").select("document_id", "xml", F.col("doc._large").alias("large"))
    # The pieces of a label are parsed by many tasks.
    return found.mapInArrow(cut, "document_id string, path array<int>, parent_section_id string, x string").repartition("document_id", "path")


def parse_pieces(pieces: DataFrame) -> DataFrame:
    parsed = F.from_xml(F.concat(F.lit("<component>"), F.col("x"), F.lit("</component>")), f"section {_section(DEPTH - 1)}")
    return pieces.select("document_id", "path", "parent_section_id", parsed.alias("c")).select("document_id", "path", "parent_section_id", F.col("c.section").alias("s"))


def escape(c: Column) -> Column:
    """Text as XML content; null gives ''. Signs that XML doesn't allow become blanks."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), r"[\x00-\x08\x0B\x0C\x0E-\x1F]", " ")
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(sign), F.lit(entity))
    return c


def tag(name: str, *attributes: tuple[str, Column], body: Column | None = None) -> Column:
    """An element; attributes that are null are left out."""
    parts = [F.lit(f"<{name}")]
    for key, value in attributes:
        parts.append(F.coalesce(F.concat(F.lit(f' {key}="'), F.when(value.isNotNull(), escape(value)), F.lit('"')), F.lit("")))
    return F.concat(*parts, F.lit(">"), F.coalesce(body, F.lit("")) if body is not None else F.lit(""), F.lit(f"</{name}>"))


def preorder(ids: list[str], parents: list[str | None]) -> tuple[list[int], list[int], list[int]]:
    """Of the rows of a forest in sibling order: the rows from the top down, the sections that end after each, the rows cut from a circle.

    A row whose parent is none of the ids is a root. A circle is cut above its first row, which
    becomes a root, so every row is there once.
    """
    place: dict[str, int] = {}
    for k, i in enumerate(ids):
        place.setdefault(i, k)
    up = [-1 if p is None else place.get(p, -1) for p in parents]
    seen, cut = [0] * len(ids), []
    for k in range(len(ids)):
        at, way = k, []
        while at >= 0 and not seen[at]:
            seen[at] = k + 1
            way.append(at)
            at = up[at]
        if at >= 0 and seen[at] == k + 1:
            first = min(way[way.index(at) :])
            up[first] = -1
            cut.append(first)
    below: list[list[int]] = [[] for _ in ids]
    for k, p in enumerate(up):
        if p >= 0:
            below[p].append(k)
    order, depths = [], []
    todo = [(k, 0) for k in reversed(range(len(ids))) if up[k] < 0]
    while todo:
        k, d = todo.pop()
        order.append(k)
        depths.append(d)
        todo += [(c, d + 1) for c in reversed(below[k])]
    return order, [d - e + 1 for d, e in zip(depths, [*depths[1:], 0], strict=True)] if order else [], sorted(cut)


def section_trees(sections: DataFrame) -> DataFrame:
    """spl_id, tops, cut: a label's sections of all depths as nested XML, and the ids of those whose parent link closes a circle.

    Siblings are ordered by section_order, then id. A section whose parent is null, no section's
    id or in another label is a root; a section in ``cut`` is written as a root too. Only ids go
    through Python; the texts are put together by expressions.
    """

    @F.pandas_udf("order array<int>, ends array<int>, cut array<int>")
    def plan(ids: pd.Series, parents: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([preorder(list(i), list(p)) for i, p in zip(ids, parents, strict=True)], columns=["order", "ends", "cut"])

    head = F.concat(
        F.lit("<component><section>"),
        tag("id", ("root", F.col("id"))),
        F.when(F.col("loinc_code").isNotNull(), tag("code", ("code", F.col("loinc_code")), ("codeSystem", F.lit(SYSTEMS["loinc"])))).otherwise(F.lit("")),
        F.when(F.col("section_title").isNotNull(), tag("title", body=escape(F.col("section_title")))).otherwise(F.lit("")),
        F.when(F.col("section_text").isNotNull(), tag("text", body=escape(F.col("section_text")))).otherwise(F.lit("")),
        tag("effectiveTime", ("value", F.date_format("effective_time", "yyyyMMdd"))),
    )
    row = F.struct(F.coalesce("section_order", F.lit(2**31 - 1)).alias("o"), "id", F.col("parent_section_id").alias("parent"), head.alias("x"))
    rows = sections.groupBy("spl_id").agg(F.array_sort(F.collect_list(row)).alias("r"))
    rows = rows.withColumn("p", plan(F.col("r.id"), F.col("r.parent")))
    parts = F.zip_with("p.order", "p.ends", lambda k, n: F.concat(F.get(F.col("r"), k)["x"], F.repeat(F.lit("</section></component>"), n)))
    return rows.select("spl_id", F.array_join(parts, "").alias("tops"), F.transform("p.cut", lambda k: F.get(F.col("r"), k)["id"]).alias("cut"))


def write_labels(meds: DataFrame, ingredients: DataFrame, sections: DataFrame) -> DataFrame:
    """spl_id, xml: a label document per medication, with its ingredients and its sections of all depths.

    Children are ordered and joined per label before the label is written; see :func:`section_trees`.
    """
    code = lambda c, system: [("code", c), ("codeSystem", F.lit(SYSTEMS[system]))]
    one = tag(
        "ingredient", ("classCode", F.when(F.col("ingredient_type") == "active", F.lit("ACTIM")).otherwise(F.lit("IACT"))),
        body=F.concat(
            F.when(
                F.col("strength_numerator").isNotNull(),
                tag("quantity", body=F.concat(
                    tag("numerator", ("value", F.col("strength_numerator").cast("string")), ("unit", F.col("strength_numerator_unit"))),
                    tag("denominator", ("value", F.col("strength_denominator").cast("string")), ("unit", F.col("strength_denominator_unit"))),
                )),
            ).otherwise(F.lit("")),
            tag("ingredientSubstance", body=F.concat(
                F.when(F.col("unii_code").isNotNull(), tag("code", *code(F.col("unii_code"), "unii"))).otherwise(F.lit("")),
                F.when(F.col("substance_name").isNotNull(), tag("name", body=escape(F.col("substance_name")))).otherwise(F.lit("")),
            )),
        ),
    )
    drugs = ingredients.select("spl_id", "id", one.alias("x")).groupBy("spl_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "x"))), lambda r: r["x"]), "").alias("drugs")
    )

    tops = section_trees(sections).drop("cut")
    product = tag("component", body=tag("section", body=F.concat(
        tag("id", ("root", F.concat(F.col("spl_id"), F.lit("-product")))),
        tag("code", *code(F.lit("48780-1"), "loinc")),
        tag("subject", body=tag("manufacturedProduct", body=F.concat(
            tag("manufacturedProduct", body=F.concat(
                F.when(F.col("ndc_code").isNotNull(), tag("code", *code(F.col("ndc_code"), "ndc"))).otherwise(F.lit("")),
                tag("name", body=escape(F.col("brand_name"))),
                tag("formCode", ("code", F.lit("C")), ("codeSystem", F.lit("2.16.840.1.113883.3.26.1.1")), ("displayName", F.col("product_form"))),
                tag("asEntityWithGeneric", body=tag("genericMedicine", body=tag("name", body=escape(F.col("generic_name"))))),
                F.coalesce("drugs", F.lit("")),
            )),
            tag("subjectOf", body=tag("marketingAct", body=F.concat(
                tag("statusCode", ("code", F.col("marketing_status"))),
                tag("effectiveTime", body=tag("low", ("value", F.date_format("marketing_date_start", "yyyyMMdd")))),
            ))),
        ))),
    )))
    document = tag(
        "document", ("xmlns", F.lit(NAMESPACE)),
        body=F.concat(
            tag("id", ("root", F.col("spl_id"))),
            tag("code", *code(F.col("document_code"), "loinc")),
            tag("effectiveTime", ("value", F.date_format("effective_date", "yyyyMMdd"))),
            tag("setId", ("root", F.col("set_id"))),
            tag("versionNumber", ("value", F.col("version_number").cast("string"))),
            tag("author", body=tag("assignedEntity", body=tag("representedOrganization", body=tag("name", body=escape(F.col("manufacturer")))))),
            tag("component", body=tag("structuredBody", body=F.concat(product, F.coalesce("tops", F.lit(""))))),
        ),
    )
    return meds.join(drugs, "spl_id", "left").join(tops, "spl_id", "left").select("spl_id", document.alias("xml"))
