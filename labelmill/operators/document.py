"""Parsed labels into documents, products, packages, ingredients, sections and media."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelmill.functions import clinical, indication, text
from labelmill.functions.ingredient import ingredient_type, normalize_substance
from labelmill.functions.units import simple_unit
from labelmill.session import free, materialize
from labelmill.sources.label_xml import DEPTH, SYSTEMS, cut_sections, large_fragments, parse_pieces, subjects

_BODY = "doc.component.structuredBody.component"
_INNER = "p.manufacturedProduct.manufacturedProduct"


def coded(c: Column) -> Column:
    """struct(code, code_system, display_name), null unless code and system are there."""
    there = (F.coalesce(c["_code"], F.lit("")) != "") & (F.coalesce(c["_codeSystem"], F.lit("")) != "")
    return F.when(there, F.struct(c["_code"].alias("code"), c["_codeSystem"].alias("code_system"), c["_displayName"].alias("display_name")))


def organizations(doc: Column) -> Column:
    """The represented organisation and those assigned to it, empty ones kept."""
    r = doc["author"]["assignedEntity"]["representedOrganization"]
    make = lambda o: F.struct(o["id"]["_extension"].alias("id_extension"), o["id"]["_root"].alias("id_root"), o["name"].alias("name"))
    assigned = F.flatten(F.transform(r["assignedEntity"], lambda e: F.coalesce(e["assignedOrganization"], F.array())))
    own = F.when(r.isNotNull(), F.array(make(r))).otherwise(F.array())
    return F.concat(own, F.coalesce(F.transform(assigned, make), F.array()))


def documents(parsed: DataFrame) -> DataFrame:
    """document_id, set_id, version_number, codes, times, organisations, success and processing_errors, one row per input row.

    A missing id is ``unknown``, a missing set the document's own, a missing version ``1``; each adds
    an error. What isn't a label has success false and only errors.
    """
    d = F.col("doc")
    ok = d["_label"]
    id_, set_ = F.nullif(d["id"]["_root"], F.lit("")), F.nullif(d["setId"]["_root"], F.lit(""))
    version = F.nullif(d["versionNumber"]["_value"], F.lit(""))
    body = d["component"]["structuredBody"]
    errors = F.array_compact(
        F.array(
            F.when(~d["_there"], F.lit("no readable text")),
            F.when(~ok, F.lit("not a label document")),
            F.when(ok & id_.isNull(), F.lit("missing document id")),
            F.when(ok & set_.isNull(), F.lit("missing set id")),
            F.when(ok & version.isNull(), F.lit("missing version number")),
            F.when(ok & body.isNull(), F.lit("missing structured body")),
        )
    )
    when = lambda c: F.when(ok, c)
    return parsed.select(
        *[c for c in parsed.columns if c not in ("xml", "doc")],
        when(F.coalesce(id_, F.lit("unknown"))).alias("document_id"),
        when(F.coalesce(set_, id_, F.lit("unknown"))).alias("set_id"),
        when(F.coalesce(version, F.lit("1"))).alias("version_number"),
        when(coded(d["code"])).alias("document_code"),
        when(d["effectiveTime"]["_value"]).alias("effective_time"),
        when(d["author"]["time"]["_value"]).alias("author_time"),
        when(organizations(d)).alias("organizations"),
        ok.alias("success"),
        errors.alias("processing_errors"),
    )


def _labels(parsed: DataFrame) -> DataFrame:
    return parsed.where("doc._label").withColumn("document_id", F.coalesce(F.nullif(F.col("doc.id._root"), F.lit("")), F.lit("unknown")))


def quarantine(parsed: DataFrame) -> DataFrame:
    """Rows that aren't label documents, with their text."""
    return parsed.where("not doc._label").drop("doc")


def sections(parsed: DataFrame) -> DataFrame:
    """Sections of the first ``DEPTH`` levels: document_id, section_id, path, depth, parent_section_id, codes, title, text, media.

    What is below the last of these levels only sets ``depth_overflow``, see :func:`all_sections`.
    Sections without id are dropped with what is below them. The order of paths is the document's order.
    """
    return _whole_sections(parsed).unionByName(_piece_sections(materialize(large_fragments(_labels(parsed), DEPTH - 1))))


def pieces(parsed: DataFrame) -> DataFrame:
    """What is cut out of the texts for :func:`all_sections` and :func:`products`, written, so that it is cut once for both."""
    return materialize(cut_sections(_labels(parsed)), "zstd")


def all_sections(parsed: DataFrame, cut: DataFrame | None = None) -> DataFrame:
    """Sections of all levels, with the columns of :func:`sections`; ``depth_overflow`` is false.

    What lies deeper than the schema is cut out of the text in pieces of ``DEPTH`` levels, a large
    label's sections one by one. ``cut``: the :func:`pieces`, where they are there.
    """
    deep = _piece_sections(parse_pieces(pieces(parsed) if cut is None else cut))
    return _whole_sections(parsed).unionByName(deep).withColumn("depth_overflow", F.lit(False))


def _whole_sections(parsed: DataFrame) -> DataFrame:
    """The first ``DEPTH`` levels of the labels that are parsed as one."""
    tops = F.transform(F.col(_BODY), lambda c, i: F.struct(F.array(i).alias("path"), F.lit(None).cast("string").alias("parent"), c["section"].alias("s")))
    return _levels(_labels(parsed).select("document_id", tops.alias("tops")))


def _piece_sections(pieces: DataFrame) -> DataFrame:
    top = F.array(F.struct("path", F.col("parent_section_id").alias("parent"), "s"))
    return _levels(pieces.select("document_id", top.alias("tops")))


def _named(nodes: Column) -> Column:
    return F.filter(nodes, lambda n: F.coalesce(n["s"]["id"]["_root"], F.lit("")) != "")


def _row(n: Column) -> Column:
    """What a section's row is made of, as it stands in the document."""
    below = n["s"]["component"]
    return F.struct(
        n["s"]["id"]["_root"].alias("section_id"), n["path"].alias("path"), n["parent"].alias("parent_section_id"), n["s"]["code"].alias("code"), n["s"]["title"].alias("title"),
        n["s"]["text"].alias("text"), n["s"]["effectiveTime"]["_value"].alias("effective_time"), F.transform(below, lambda c: c["observationMedia"]).alias("observed"),
        ((F.size(n["path"]) == DEPTH) & F.exists(below, lambda c: c["section"].isNotNull())).alias("deeper"),
    )


def _levels(df: DataFrame) -> DataFrame:
    """The sections ``tops`` (path, parent, s) of a row and ``DEPTH - 1`` levels below them: nested transforms, one flatten, one inline."""
    step = lambda n: F.transform(n["s"]["component"], lambda c, i: F.struct(F.concat(n["path"], F.array(i)).alias("path"), n["s"]["id"]["_root"].alias("parent"), c["section"].alias("s")))
    level, rows = "tops", []
    df = df.withColumn(level, _named(F.col(level)))
    for k in range(DEPTH):
        rows.append(F.coalesce(F.transform(level, _row), F.array()))
        if k < DEPTH - 1:
            df = df.withColumn(f"_l{k}", _named(F.flatten(F.filter(F.transform(level, step), lambda x: x.isNotNull()))))
            level = f"_l{k}"
    flat = df.select("document_id", F.inline(F.flatten(F.array(*rows))))
    media = F.filter(
        F.transform(
            F.col("observed"),
            lambda m, i: F.struct(
                F.coalesce(m["_ID"], F.concat(F.lit("media_"), (i + 1).cast("string"))).alias("media_id"), F.coalesce(m["value"]["_mediaType"], F.lit("unknown")).alias("media_type"),
                m["value"]["reference"]["_value"].alias("reference_value"), m["text"].alias("description"),
            ),
        ),
        lambda m: m["reference_value"].isNotNull(),
    )
    return flat.select(
        "document_id", "section_id", "path", (F.size("path") - 1).alias("depth"), "parent_section_id", coded(F.col("code")).alias("section_code"), "title",
        xml_text(F.col("text")).alias("text_content"), "effective_time", F.concat(inline_media(F.col("text")), F.coalesce(media, F.array())).alias("media"),
        F.coalesce("deeper", F.lit(False)).alias("depth_overflow"),
    )


def xml_text(c: Column) -> Column:
    """Text of mixed content: items get a bullet, other tags a blank, captions of lists go, white space collapses."""
    t = F.regexp_replace(c, r"(?s)(<list(?:\s[^<>]*)?>)\s*<caption[^<>]*>.*?</caption>", "$1")
    t = F.regexp_replace(F.regexp_replace(t, r"<item(\s[^<>]*)?>", " • "), r"</?[A-Za-z][^<>]*>", " ")
    return F.when(c.isNotNull(), F.coalesce(F.trim(F.regexp_replace(t, r"(?U)\s+", " ")), F.lit("")))


def media_references(c: Column) -> Column:
    """Ids that renderMultiMedia elements of a text refer to."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r'<renderMultiMedia\b[^<>]*referencedObject="([^"]*)"'), F.lit(1))


def inline_media(c: Column) -> Column:
    """The references of a text as media of type ``reference``; they stand before the section's own media."""
    return F.transform(
        media_references(c),
        lambda r: F.struct(r.alias("media_id"), F.lit("reference").alias("media_type"), r.alias("reference_value"), F.lit(None).cast("string").alias("description")),
    )


def products(parsed: DataFrame, cut: DataFrame | None = None) -> DataFrame:
    """Every product of the top-level sections: document_id, path, the section's code, the product's fields, its ingredients and packages.

    ``cut``: the :func:`pieces`, where they are there.
    """
    rows = _labels(parsed).select("document_id", F.posexplode(F.col(_BODY)).alias("i", "c"))
    rows = rows.select("document_id", "i", F.col("c.section.code._code").alias("listed_in"), F.posexplode(F.col("c.section.subject")).alias("k", "s"))
    large = subjects(cut_sections(_labels(parsed).where("doc._large"), 0) if cut is None else cut).select("document_id", F.col("path")[0].alias("i"), F.col("s.code._code").alias("listed_in"), F.posexplode(F.col("s.subject")).alias("k", "s"))
    rows = rows.unionByName(materialize(large))  # written, so that the large labels are cut once
    rows = rows.select("document_id", F.array("i", "k").alias("path"), "listed_in", F.col("s.manufacturedProduct").alias("p")).where(F.col("p.manufacturedProduct").isNotNull())
    n = F.col("p.manufacturedProduct")
    act = F.get(F.filter(F.col("p.subjectOf"), lambda s: s["marketingAct"].isNotNull()), F.lit(0))["marketingAct"]
    approval = F.get(F.filter(F.col("p.subjectOf"), lambda s: s["approval"].isNotNull()), F.lit(0))["approval"]
    routes = F.filter(F.transform(F.col("p.consumedIn"), lambda r: coded(r["substanceAdministration"]["routeCode"])), lambda r: r.isNotNull())
    return rows.select(
        "document_id", "path", "listed_in", coded(n["code"]).alias("product_code"), F.trim(n["name"]["_VALUE"]).alias("name"), F.trim(n["name"]["suffix"]).alias("suffix"),
        F.nullif(F.trim(n["asEntityWithGeneric"]["genericMedicine"]["name"]), F.lit("")).alias("generic_name"), coded(n["formCode"]).alias("form"), coded(act["code"]).alias("marketing_code"),
        act["statusCode"]["_code"].alias("marketing_status"), act["effectiveTime"]["low"]["_value"].alias("marketing_low"),
        act["effectiveTime"]["high"]["_value"].alias("marketing_high"), approval["id"]["_extension"].alias("approval_id"), coded(approval["code"]).alias("approval_type"),
        approval["author"]["territorialAuthority"]["territory"]["code"]["_code"].alias("territory"), F.coalesce(routes, F.array()).alias("routes"),
        n["ingredient"].alias("ingredients"), n["asContent"].alias("contents"),
    )


def quantity(numerator: Column, denominator: Column) -> Column:
    """The ratio, null unless the numerator is a number; a missing or odd denominator is 1."""
    value = numerator["_value"].try_cast("double")
    return F.when(
        value.isNotNull(),
        F.struct(
            value.alias("numerator_value"), simple_unit(numerator["_unit"]).alias("numerator_unit"),
            F.coalesce(denominator["_value"].try_cast("double"), F.lit(1.0)).alias("denominator_value"), simple_unit(denominator["_unit"]).alias("denominator_unit"),
        ),
    )


def product_ingredients(found: DataFrame) -> DataFrame:
    """document_id, path, pos, type, substance code and name, quantity, active moiety; odd classes and nameless rows are dropped."""
    rows = found.select("document_id", "path", F.posexplode("ingredients").alias("pos", "g"))
    s = F.col("g.ingredientSubstance")
    kind = ingredient_type(F.col("g._classCode"))
    moiety = s["activeMoiety"]["activeMoiety"]
    rows = rows.select(
        "document_id", "path", "pos", kind.alias("ingredient_type"), coded(s["code"]).alias("substance_code"), normalize_substance(s["name"]).alias("substance_name"),
        quantity(F.col("g.quantity.numerator"), F.col("g.quantity.denominator")).alias("quantity"),
        F.when(kind == "active", moiety["code"]["_code"]).alias("moiety_code"), F.when(kind == "active", moiety["name"]).alias("moiety_name"),
    )
    return rows.where("ingredient_type is not null and (substance_code is not null or substance_name is not null)")


def packages(found: DataFrame) -> DataFrame:
    """document_id, path, pos, quantity and codes of all packages."""
    rows = found.select("document_id", "path", F.posexplode("contents").alias("pos", "c"))
    q = F.col("c.quantity")
    return rows.select(
        "document_id", "path", "pos", q["numerator"]["_value"].try_cast("decimal(10,3)").alias("package_quantity"), q["numerator"]["_unit"].alias("package_unit"),
        coded(F.col("c.containerPackagedProduct.code")).alias("package_code"), coded(F.col("c.containerPackagedProduct.formCode")).alias("package_form"),
    )


# Date formats of labels, tried in this order.
LOAD_FORMATS = ["yyyyMMdd", "yyyy-MM-dd", "yyyyMMddHHmmss", "yyyy-MM-dd'T'HH:mm:ss"]
# Code of the section that lists the products.
LISTING = "48780-1"


def load_date(c: Column) -> Column:
    """The day of a date in one of the four formats, else null."""
    return F.coalesce(*[F.try_to_timestamp(F.trim(c), F.lit(f)) for f in LOAD_FORMATS]).cast("date")


def numbered(sections: DataFrame) -> DataFrame:
    """Adds section_order: 1, 2, ... through a document from the top down; a document is one row before it is parsed, so its sections are bounded."""
    return sections.withColumn("section_order", F.row_number().over(Window.partitionBy("document_id").orderBy("path")))


def load_tables(parsed: DataFrame, loaded_at: Column | None = None, products_only: bool = False) -> dict[str, DataFrame]:
    """The relational tables of parsed labels: medications, ingredients, spl_sections, indications, additional_ndc_codes.

    ``products_only``: only those that are made of the products (ingredients, additional_ndc_codes); no section is read for them.

    They have all columns that the search views read. Codes count only in their own code system;
    keys are hashes of what identifies a row. A label's product is the first one of its first
    listing section that has one; section_order runs through a label from the top down; a section's
    text is rewritten by its type. ``loaded_at`` (now, unless given) is the time of processing.
    """
    now = F.current_timestamp() if loaded_at is None else loaded_at
    cut = None if products_only else pieces(parsed)
    found = products(parsed, cut)
    day = load_date
    system = lambda c, s: F.when(c["code_system"] == SYSTEMS[s], c["code"])
    shown = lambda c: F.coalesce(c["display_name"], c["code"])
    key = lambda *c: F.sha2(F.concat_ws("|", *c), 256)
    drugs = product_ingredients(found)
    ingredients = drugs.select(
        key("document_id", F.array_join("path", "."), "pos").alias("id"), F.col("document_id").alias("spl_id"), "ingredient_type", "substance_name",
        system(F.col("substance_code"), "unii").alias("unii_code"), F.col("quantity.numerator_value").try_cast("decimal(15,6)").alias("strength_numerator"),
        F.col("quantity.numerator_unit").alias("strength_numerator_unit"), F.col("quantity.denominator_value").try_cast("decimal(15,6)").alias("strength_denominator"),
        F.col("quantity.denominator_unit").alias("strength_denominator_unit"), F.col("moiety_name").alias("active_moiety_name"), F.col("moiety_code").alias("active_moiety_unii"),
        now.alias("created_at"),
    )
    boxes = packages(found)
    codes = boxes.select(
        key("document_id", F.array_join("path", "."), "pos").alias("id"), F.col("document_id").alias("spl_id"), system(F.col("package_code"), "ndc").alias("ndc_code"),
        F.concat_ws(" ", F.col("package_quantity").cast("string"), shown(F.col("package_form"))).alias("package_description"), F.col("package_quantity").cast("string").alias("package_size"),
        "package_quantity", "package_unit", now.alias("created_at"),
    )
    codes = codes.where("ndc_code is not null")
    if products_only:
        return {"ingredients": ingredients, "additional_ndc_codes": codes}
    docs = documents(parsed).where("success and document_id != 'unknown'")
    # Written twice, so that the levels are walked once and each text is rewritten once.
    read = materialize(all_sections(parsed, cut), "zstd")
    secs = materialize(numbered(section_table(read)), "zstd")
    free(read, cut)
    first = found.where(F.col("listed_in") == LISTING).groupBy("document_id").agg(F.min(F.struct("path", "product_code", "name", "suffix", "generic_name", "form", "marketing_status", "marketing_low", "approval_type", "approval_id", "routes")).alias("p"))
    p = F.col("p")
    summary = secs.groupBy("document_id").agg(
        F.count("*").alias("total_sections"), F.count_if(F.length("text_content") > 0).alias("with_text"),
        F.array_sort(F.collect_set(F.col("section_code.code"))).alias("section_types"),
    )
    company = F.col("organizations")[0]["name"]
    meds = docs.join(first, "document_id", "left").join(summary, "document_id", "left").select(
        F.col("document_id").alias("spl_id"), "set_id", F.col("version_number").try_cast("int").alias("version_number"), day(F.col("effective_time")).alias("effective_date"),
        F.nullif(F.concat_ws(" ", F.nullif(p["name"], F.lit("")), F.nullif(p["suffix"], F.lit(""))), F.lit("")).alias("brand_name"), p["generic_name"].alias("generic_name"),
        company.alias("manufacturer"), company.alias("labeler"), system(p["product_code"], "ndc").alias("ndc_code"), shown(p["form"]).alias("product_form"),
        F.nullif(F.array_join(F.transform(p["routes"], shown), ", "), F.lit("")).alias("route_of_administration"), shown(p["approval_type"]).alias("approval_type"),
        p["approval_id"].alias("approval_id"), p["marketing_status"].alias("marketing_status"),
        p["marketing_status"].isin("active", "inactive", "discontinued").alias("is_valid_marketing_status"), day(p["marketing_low"]).alias("marketing_date_start"),
        F.col("document_code.code").alias("document_code"), F.col("document_code.display_name").alias("document_display_name"),
        F.to_json(F.struct("organizations", F.struct("total_sections", "with_text", "section_types").alias("section_summary"), F.nullif(F.array_join("processing_errors", "; "), F.lit("")).alias("processing_errors"))).alias("additional_data"),
        now.alias("processed_at"), F.lit("completed").alias("processing_status"), F.nullif(F.array_join("processing_errors", "; "), F.lit("")).alias("processing_errors"),
        now.alias("created_at"), now.alias("updated_at"),
    )
    loinc = system(F.col("section_code"), "loinc")
    parts = secs.select(
        key("document_id", F.array_join("path", ".")).alias("id"), F.col("document_id").alias("spl_id"), "section_id", loinc.alias("loinc_code"), F.col("title").alias("section_title"),
        text.section_text(F.col("clinical_text")).alias("section_text"), "section_order", "path", day(F.col("effective_time")).alias("effective_time"),
        F.when(F.size("path") > 1, key("document_id", F.array_join(F.slice("path", 1, F.size("path") - 1), "."))).alias("parent_section_id"), now.alias("created_at"),
    )
    t = F.col("section_text")
    own = parts.where((F.col("loinc_code") == "34067-9") & t.isNotNull())
    other = parts.join(own.select("spl_id").distinct(), "spl_id", "left_anti").where((F.size("path") == 1) & indication.mentions_use(t))
    other = other.groupBy("spl_id").agg(F.min(F.struct("path", "section_text")).alias("f")).select("spl_id", F.col("f.section_text").alias("section_text"), F.lit("secondary").alias("indication_type"))
    both = own.select("spl_id", "section_text", indication.indication_type(t).alias("indication_type")).unionByName(other)
    indications = both.select(
        key("spl_id", "section_text").alias("id"), "spl_id", F.col("section_text").alias("indication_text"), "indication_type",
        indication.condition_name(t).alias("condition_name"), indication.population(t).alias("population_restriction"), now.alias("created_at"),
    )
    return {"medications": meds, "ingredients": ingredients, "spl_sections": parts, "indications": indications, "additional_ndc_codes": codes}


def section_table(secs: DataFrame) -> DataFrame:
    """Parsed sections with type, strategy and rewritten text."""
    code = F.col("section_code.code")
    kind = clinical.section_type(code)
    return secs.withColumn("section_type", kind).withColumn("strategy", clinical.strategy(code)).withColumn(
        "clinical_text", F.when(F.col("strategy") == "GENERIC", F.col("text_content")).otherwise(clinical.clinical_text(F.col("text_content"), kind))
    )
