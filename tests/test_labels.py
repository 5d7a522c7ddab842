"""Label documents: parsing, archives, tables, streaming."""

import io
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from labelmill.operators import document as D
from labelmill.operators import validation
from labelmill.sources import discover, label_xml
from labelmill.sources.label_xml import NAMESPACE, parse, read_xml_dir, read_xml_zip
from labelmill.streaming.ingest import current_table, event_windows, upsert_stream

CODE = 'codeSystem="2.16.840.1.113883.6.1"'


def section(id, code, inner="", text=None, title=None):
    t = f"<title>{title}</title>" if title else ""
    x = f"<text>{text}</text>" if text is not None else ""
    return f'<component><section><id root="{id}"/><code code="{code}" {CODE}/>{t}{x}<effectiveTime value="20171103"/>{inner}</section></component>'


PRODUCT = """<subject><manufacturedProduct><manufacturedProduct><code code="77001-212" codeSystem="2.16.840.1.113883.6.69"/><name>Brand<suffix>Kids</suffix></name>
<formCode code="C1" codeSystem="9" displayName="TABLET"/><asEntityWithGeneric><genericMedicine><name>Generic</name></genericMedicine></asEntityWithGeneric>
<ingredient classCode="ACTIM"><quantity><numerator value="40" unit="mg"/><denominator value="1" unit="1"/></quantity><ingredientSubstance>
<code code="Q7ZX10WVUT" codeSystem="2.16.840.1.113883.4.9"/><name>Stuff  one</name><activeMoiety><activeMoiety><code code="M1" codeSystem="2.16.840.1.113883.4.9"/><name>Moiety</name></activeMoiety></activeMoiety></ingredientSubstance></ingredient>
<ingredient classCode="IACT"><ingredientSubstance><name>Red &amp; Blue</name></ingredientSubstance></ingredient><ingredient classCode="ODD"><ingredientSubstance><name>No</name></ingredientSubstance></ingredient>
<asContent><quantity><numerator value="30" unit="1"/><denominator value="1"/></quantity><containerPackagedProduct><code code="77001-212-30" codeSystem="2.16.840.1.113883.6.69"/><formCode code="C2" codeSystem="9" displayName="BOX"/></containerPackagedProduct></asContent>
<asContent><quantity><numerator value="90" unit="1"/></quantity><containerPackagedProduct><code code="77001-212-90" codeSystem="2.16.840.1.113883.6.69"/></containerPackagedProduct></asContent></manufacturedProduct>
<subjectOf><approval><id extension="PERMIT-88"/><code code="C7" codeSystem="9" displayName="INVENTED KIND"/></approval></subjectOf>
<subjectOf><marketingAct><code code="C5" codeSystem="9"/><statusCode code="active"/><effectiveTime><low value="20160209"/></effectiveTime></marketingAct></subjectOf>
<consumedIn><substanceAdministration><routeCode code="C3" codeSystem="9" displayName="ORAL"/></substanceAdministration></consumedIn></manufacturedProduct></subject>"""
MEDIA = '<component><observationMedia ID="PIC7"><text>Side view</text><value mediaType="image/png"><reference value="leaf.png"/></value></observationMedia></component>'


def label(id="doc-1", body="", version='<versionNumber value="2"/>'):
    return (
        f'<?xml version="1.0"?><document xmlns="{NAMESPACE}"><id root="{id}"/><code code="34390-5" {CODE} displayName="LEAFLET"/><effectiveTime value="20171103"/><setId root="set-1"/>{version}'
        '<author><time/><assignedEntity><representedOrganization><id extension="1" root="2"/><name>Maker</name><assignedEntity><assignedOrganization/></assignedEntity>'
        f"</representedOrganization></assignedEntity></author><component><structuredBody>{body}</structuredBody></component></document>"
    )


def nest(depth):
    out = ""
    for k in reversed(range(depth)):
        out = section(f"s{k}", "42229-5", out)
    return out


BODY = (
    section("s1", "48780-1", PRODUCT)
    + section("s2", "34071-1", section("s3", "50570-1", text="<paragraph><content>Do not use</content> in children</paragraph>") + section("s4", "50567-7", text="<list><caption>no</caption><item>a &lt;5</item><item>b</item></list> tail"), title="Warnings")
    + section("s5", "34067-9", text="treats motion sickness in adults")
    + section("s6", "51945-4", MEDIA, text='see <renderMultiMedia referencedObject="PIC7"/>')
)


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [label(body=BODY), label("doc-2", nest(8)), "<html><id/></html>", "<document", "", None, label("doc-3", "", "")]
    return parse(spark.createDataFrame([(x,) for x in rows], "xml string")).cache()


def test_documents(parsed):
    docs = D.documents(parsed).collect()
    good = {d.document_id: d for d in docs if d.success}
    assert set(good) == {"doc-1", "doc-2"}
    d = good["doc-1"]
    assert (d.set_id, d.version_number, d.document_code.code, len(d.organizations), d.organizations[0].name) == ("set-1", "2", "34390-5", 2, "Maker")
    assert D.quarantine(parsed).count() == 5


def test_sections(parsed):
    rows = {r.section_id: r for r in D.sections(parsed).where("document_id = 'doc-1'").collect()}
    assert {k: (r.depth, r.parent_section_id) for k, r in rows.items()} == {"s1": (0, None), "s2": (0, None), "s3": (1, "s2"), "s4": (1, "s2"), "s5": (0, None), "s6": (0, None)}
    assert rows["s3"].text_content == "Do not use in children"
    assert rows["s4"].text_content == "• a <5 • b tail"
    assert rows["s2"].title == "Warnings" and rows["s2"].text_content is None
    assert [(m.media_id, m.media_type, m.reference_value, m.description) for m in rows["s6"].media] == [
        ("PIC7", "reference", "PIC7", None), ("PIC7", "image/png", "leaf.png", "Side view"),
    ]
    deep = D.sections(parsed).where("document_id = 'doc-2'").collect()
    assert sorted(r.depth for r in deep) == list(range(6)) and sum(r.depth_overflow for r in deep) == 1


def test_products(parsed):
    p = D.products(parsed).first()
    assert (p.name, p.suffix, p.generic_name, p.product_code.code, p.marketing_status, p.approval_id, p.approval_type.display_name) == (
        "Brand", "Kids", "Generic", "77001-212", "active", "PERMIT-88", "INVENTED KIND",
    )
    found = D.product_ingredients(D.products(parsed)).orderBy("pos").collect()
    assert [(i.ingredient_type, i.substance_name, i.moiety_name) for i in found] == [("active", "STUFF ONE", "Moiety"), ("inactive", "RED & BLUE", None)]
    assert found[0].quantity.numerator_value == 40.0 and found[1].quantity is None


def test_tables(parsed):
    t = D.load_tables(parsed)
    m = t["medications"].where("spl_id = 'doc-1'").first()
    assert (m.version_number, m.brand_name, m.ndc_code, m.product_form, m.route_of_administration, m.manufacturer) == (2, "Brand Kids", "77001-212", "TABLET", "ORAL", "Maker")
    assert t["additional_ndc_codes"].count() == 2 and t["ingredients"].count() == 2
    i = t["indications"].first()
    assert (i.indication_type, i.condition_name, i.population_restriction) == ("primary", "motion sickness in adults", "Adults")


def test_media_references(one):
    assert one(D.media_references, 'x <renderMultiMedia referencedObject="PIC7"/>') == ["PIC7"]
    assert one(D.media_references, None) == []


def test_xml_folder(spark, tmp_path):
    (tmp_path / "a.xml").write_text(label().replace("><", ">\n<"))
    (tmp_path / "b.txt").write_text("no")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.xml").write_text(label("c"))
    assert read_xml_dir(spark, str(tmp_path)).count() == 1
    assert read_xml_dir(spark, str(tmp_path), recursive=True).count() == 2
    assert read_xml_dir(spark, str(tmp_path), recursive=True, first=1).count() == 1


def zipped(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, content in files.items():
            z.writestr(name, content)
    return out.getvalue()


def test_archives(spark, tmp_path):
    inner = zipped({"x.xml": label("x"), "pic.jpg": b"1"})
    (tmp_path / "dm_spl_release_1.zip").write_bytes(zipped({"otc/one.zip": inner, "otc/bad.zip": b"no zip"}))
    (tmp_path / "dm_spl_release_2.zip").write_bytes(zipped({"rx/one.zip": inner, "rx/two.zip": zipped({"y.xml": label("y")})}))
    (tmp_path / "dm_spl_release_3.zip").write_bytes(b"broken")
    rows = sorted((r.category, r.inner, r.name) for r in read_xml_zip(spark, str(tmp_path)).collect())
    assert rows == [("otc", "one.zip", "x.xml"), ("rx", "two.zip", "y.xml")]
    assert discover.file_catalog(spark, str(tmp_path), "*.zip").count() == 3


def test_links(spark):
    page = '<a href="/other_human_rx.zip">o</a><h3>Full Releases</h3><a href="a_human_rx.zip">a</a><a href="/x/a_human_rx.zip">a</a><a href="https://e.org/b_animal.zip">b</a><a href="c.zip">c</a>'
    df = spark.createDataFrame([("https://h.org/d/i.html", page), ("https://h.org/", None), ("https://h.org/", "none")], "url string, html string")
    got = [(r.url, r.filename) for r in discover.release_links(df).orderBy("position").collect()]
    assert got == [("https://h.org/d/a_human_rx.zip", "a_human_rx.zip"), ("https://e.org/b_animal.zip", "b_animal.zip")]


def test_stream(spark, tmp_path):
    src, target = str(tmp_path / "in"), f"file://{tmp_path}/table"
    schema = "k string, at int, v string"
    spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], schema).coalesce(1).write.parquet(src)
    check = f"file://{tmp_path}/check"
    stream = lambda: spark.readStream.schema(schema).parquet(src)
    assert current_table(spark, target) is None
    upsert_stream(stream(), target, ["k"], "at", check)
    spark.createDataFrame([("b", 2, "new"), ("a", 0, "old")], schema).coalesce(1).write.mode("append").parquet(src)
    upsert_stream(stream(), target, ["k"], "at", check)
    assert {(r.k, r.at, r.v) for r in current_table(spark, target).collect()} == {("a", 2, "y"), ("b", 2, "new")}


def test_event_windows(spark):
    df = spark.createDataFrame([("2024-01-01 00:10:00", "x", 1.0), ("2024-01-01 00:50:00", "x", 2.0)], "ts string, event_type string, value double")
    assert [(r.n, r.total) for r in event_windows(df.withColumn("ts", F.to_timestamp("ts"))).collect()] == [(2, 3.0)]


def test_windows_of_a_stream(spark, tmp_path):
    """Two arrivals into one window, the second after a restart; nothing new changes nothing."""
    from labelmill.streaming.ingest import window_table

    src, target, check = str(tmp_path / "in"), f"file://{tmp_path}/out", f"file://{tmp_path}/check"
    put = lambda rows: spark.createDataFrame(rows, "t string, event_type string, value double").selectExpr("to_timestamp(t) ts", "event_type", "value").coalesce(1).write.mode("append").parquet(src)
    put([("2024-01-01 00:10:00", "x", 1.0), ("2024-01-01 01:10:00", "x", 5.0)])
    stream = lambda: spark.readStream.schema("ts timestamp, event_type string, value double").parquet(src)
    assert window_table(stream(), target, checkpoint=check).count() == 2
    put([("2024-01-01 00:50:00", "x", 2.0)])
    got = window_table(stream(), target, checkpoint=check)
    want = [(0, 2, 3.0), (1, 1, 5.0)]
    assert sorted((r.window_start.hour, r.n, r.total) for r in got.collect()) == want
    assert sorted((r.window_start.hour, r.n, r.total) for r in window_table(stream(), target, checkpoint=check).collect()) == want


def test_validation(spark):
    rows = spark.createDataFrame([("invalid-uuid", None, "20241301"), ("11111111-1111-1111-1111-111111111111", "x", "2024")], "spl_id string, t string, d string")
    got = validation.messages(rows, "spl_id", "c", [validation.uuid("spl_id"), validation.required("t"), validation.date_text("d")])
    assert sorted((r.severity, r.field) for r in got.collect()) == [("error", "d"), ("error", "spl_id"), ("error", "t"), ("warning", "d")]


def test_pipeline(spark, tmp_path):
    from labelmill.plans import pipeline

    src = tmp_path / "in"
    src.mkdir()
    (src / "a.xml").write_text(label(body=BODY))
    (src / "b.xml").write_text("<broken")
    out = pipeline.run(spark, str(src), f"file://{tmp_path}/out")
    r = out["report"].first()
    assert (r.n_files, r.n_labels, r.n_failed, r.success_rate, r.n_sections, r.n_products, r.n_active, r.n_valid, r.n_invalid) == (2, 1, 1, 50.0, 6, 1, 1, 0, 1)
    files = {d.path.rsplit("/", 1)[-1]: d for d in out["documents"].collect()}
    assert (files["a.xml"].success, files["a.xml"].n_sections, files["a.xml"].n_active, files["a.xml"].error) == (True, 6, 1, None)
    assert (files["b.xml"].success, files["b.xml"].error, files["b.xml"].n_sections) == (False, "not a label document", 0)
    assert {k: v.count() for k, v in out.items() if k in ("medications", "ingredients", "spl_sections", "indications", "additional_ndc_codes", "quarantine")} == {
        "medications": 1, "ingredients": 2, "spl_sections": 6, "indications": 1, "additional_ndc_codes": 2, "quarantine": 1,
    }
    with pytest.raises(Exception, match="not a label document"):
        pipeline.run(spark, str(src), f"file://{tmp_path}/strict", pipeline.Options(strict=True))


def test_loaded_labels_can_be_queried(spark, tmp_path):
    """The views, the summary and the lookups run over what the pipeline has written."""
    from labelmill.plans import pipeline, views

    src, target = tmp_path / "in", f"file://{tmp_path}/out"
    src.mkdir()
    (src / "a.xml").write_text(label(body=BODY))
    (src / "c.xml").write_text(label("doc-2", nest(8)).replace('value="20171103"/><setId', 'value="2017-11-03"/><setId'))
    (src / "bytes.xml").write_bytes(b"<document>\xff\xfe</document>")
    out = pipeline.run(spark, str(src), target, pipeline.Options(json=True))
    pipeline.register_views(spark, target)
    found = {r.spl_id: r for r in spark.table("medication_search").collect()}
    assert found["doc-1"].active_ingredients == ["STUFF ONE"] and found["doc-1"].additional_ndcs == ["77001-212-30", "77001-212-90"]
    assert str(found["doc-2"].effective_date) == "2017-11-03" and found["doc-2"].brand_name is None
    name = {r.id: (r.spl_id, r.section_id) for r in out["spl_sections"].collect()}
    content = {name[r.id][1]: r for r in spark.table("section_content").where("spl_id = 'doc-1'").collect()}
    assert content["s5"].section_type_name == "Indications and Usage" and content["s4"].section_text == "• a <5 • b tail"
    assert content["s3"].section_text == "DO NOT USE in children"
    assert [(r.substance_name, r.medication_count) for r in spark.table("active_ingredients_summary").collect()] == [("STUFF ONE", 1)]
    assert {r.spl_id: r.n_sections for r in views.document_summary(spark, target).collect()} == {"doc-1": 6, "doc-2": 8}
    listed = out["spl_sections"].orderBy("spl_id", "section_order").collect()
    assert [(r.spl_id, r.section_order, r.section_id) for r in listed] == [("doc-1", k, f"s{k}") for k in range(1, 7)] + [("doc-2", k + 1, f"s{k}") for k in range(8)]
    assert {r.section_id: name.get(r.parent_section_id) for r in listed if r.spl_id == "doc-1"}["s4"] == ("doc-1", "s2")
    assert out["documents"].where("error like 'no readable text%'").count() == 1
    assert out["messages"].where("context = 'product' and field = 'product_code.code_system'").count() == 0
    keys = spark.createDataFrame([("doc-1",), ("gone",), (None,)], "spl_id string")
    assert [r.spl_id for r in views.get_records(out["medications"], keys, ["spl_id"]).collect()] == ["doc-1"]
    assert {r.spl_id: r.exists for r in views.which_exist(out["medications"], keys, ["spl_id"]).collect()} == {"doc-1": True, "gone": False, None: False}
    assert spark.read.json(f"{target}/report.jsonl").count() == 1
    with pytest.raises(Exception, match="invalid label"):
        pipeline.run(spark, str(src), f"file://{tmp_path}/strict", pipeline.Options(strict_validation=True))


def test_product_of_the_listing_section(spark):
    """The first product of the first listing section, not of an earlier section of another kind."""
    other = PRODUCT.replace("<name>Brand<suffix>Kids</suffix></name>", "<name>Other</name>")
    body = section("x", "42229-5", other) + section("y", "48780-1") + section("z", "48780-1", PRODUCT)
    meds = D.load_tables(parse(spark.createDataFrame([(label(body=body),)], "xml string")))["medications"]
    assert [r.brand_name for r in meds.collect()] == ["Brand Kids"]


def test_code_and_date_rules(spark):
    rows = spark.sql("""select 'a' spl_id, '2017' d, named_struct('code', 'x', 'code_system', 'odd') c union all select 'b', '20171303', named_struct('code', '', 'code_system', '2.16.840.1.113883.6.1')
        union all select 'c', null, null""")
    got = validation.messages(rows, "spl_id", "k", [validation.date_text("d"), *validation.coded("c")]).collect()
    assert sorted((r.spl_id, r.severity, r.field) for r in got) == [("a", "warning", "c.code_system"), ("a", "warning", "d"), ("b", "error", "c.code"), ("b", "error", "d")]


def test_catalogue_and_batches(spark, tmp_path):
    from labelmill.operators import metrics

    runs = spark.createDataFrame([("a", True, 1.0), ("a", False, 3.0), ("b", True, 2.0)], "batch string, ok boolean, s double")
    assert tuple(metrics.compare_batches(runs, "batch", "ok", "s").first()) == (2, 75.0, 100.0, 50.0, 3.0, 3, 2)
    assert tuple(metrics.compare_batches(runs.limit(0), "batch", "ok", "s").first()) == (0, None, None, None, None, 0, 0)
    kinds = spark.createDataFrame([("otc",), ("otc",), (None,)], "c string")
    assert {(r.category, r.n_files) for r in metrics.files_per_category(kinds, "c").collect()} == {("otc", 2), ("", 1)}
    entries = spark.sql("select 'f.zip' filename, 'u' url, 'p' local_path, 5L file_size, 'm' md5_hash, timestamp'2020-01-02 03:04:05' download_time")
    discover.write_tracker(entries, f"file://{tmp_path}/log")
    (tmp_path / "log" / "bad.json").write_text("{broken")
    assert [tuple(r)[:5] for r in discover.read_tracker(spark, f"file://{tmp_path}/log").collect()] == [("f.zip", "u", "p", 5, "m")]
    assert metrics.missing_files(entries, spark.createDataFrame([("f.zip",)], "filename string"), "filename").count() == 1
    (tmp_path / "one.txt").write_text("abc")
    row = discover.file_catalog(spark, str(tmp_path), "*.txt").where("filename = 'one.txt'").first()
    assert (row.file_size, row.md5_hash) == (3, "900150983cd24fb0d6963f7d28e17f72")


def test_confidence(spark):
    from labelmill.plans import pipeline

    df = spark.sql("select array(named_struct('n', 1, 'confidence_score', 0.9D), named_struct('n', 2, 'confidence_score', cast(null as double))) as a")
    assert [x.n for x in df.select(pipeline.high_confidence("a").alias("v")).first().v] == [1]
    assert [x.n for x in df.select(pipeline.needs_review("a").alias("v")).first().v] == [2]


def test_sections_of_all_depths(spark):
    """Deeper than the schema, with entities, comments and media on the way; below a section without id there is nothing."""
    deep = ""
    for k in reversed(range(20)):
        deep = MEDIA + section(f"d{k}", "42229-5", deep, text=f"<paragraph>a &lt;{k} &amp;amp;</paragraph><!-- <section> -->", title=f"&quot;{k}&gt;")
    lost = nest(15).replace('<id root="s3"/>', "")
    got = D.all_sections(parse(spark.createDataFrame([(label("a", deep + section("z", "42229-5")),), (label("b", lost),)], "xml string"))).collect()
    rows = {r.section_id: r for r in got if r.document_id == "a"}
    assert {k: (r.depth, r.parent_section_id, list(r.path)) for k, r in rows.items()} == {
        **{f"d{k}": (k, f"d{k - 1}" if k else None, [1] * (k + 1)) for k in range(20)}, "z": (0, None, [2]),
    }
    assert all(rows[f"d{k}"].text_content == f"a <{k} &amp;" and rows[f"d{k}"].title == f'"{k}>' for k in range(20))
    assert all(len(rows[f"d{k}"].media) == (k < 19) for k in range(20)) and not any(r.depth_overflow for r in got)
    assert sorted(r.section_id for r in got if r.document_id == "b") == ["s0", "s1", "s2"]


def test_large_labels_are_cut_into_sections(spark, monkeypatch):
    """A label that is too large to be parsed as one value gives the same rows; its parsed form doesn't grow with its sections."""
    deep = ""
    for k in reversed(range(15)):
        deep = MEDIA + section(f"d{k}", "42229-5", deep + section(f"e{k}", "34084-4"), text=f"<paragraph>a &lt;{k} &amp;amp;</paragraph><!-- <section> -->", title=f"&quot;{k}&gt;")
    lost = nest(9).replace('<id root="s3"/>', "")
    rows = [label("a", BODY), label("b", MEDIA + section("m", "34066-1") + deep + section("z", "48780-1", PRODUCT + PRODUCT)), label("c", lost), label("d", nest(6)), label("e", ""), label("f", BODY)[:-20], label("g", BODY, ""), "<html/>", "", None]
    rows.append(label("h").replace("<component><structuredBody></structuredBody></component>", ""))
    given = spark.createDataFrame([(x,) for x in rows], "xml string")
    columns = {"medications": "processed_at created_at updated_at", "ingredients": "created_at", "spl_sections": "created_at", "indications": "created_at", "additional_ndc_codes": "created_at"}

    def found(large):
        monkeypatch.setattr(label_xml, "LARGE", large)
        parsed = parse(given).cache()
        out = {"bodies": parsed.where("size(doc.component.structuredBody.component) > 0").count(), "quarantine": D.quarantine(parsed), "documents": D.documents(parsed), "sections": D.sections(parsed), "all": D.all_sections(parsed), "products": D.products(parsed)}
        out |= {k: t.drop(*columns[k].split()) for k, t in D.load_tables(parsed).items()}
        assert {k: sorted(map(str, t.drop(*columns[k].split()).collect())) for k, t in D.load_tables(parsed, products_only=True).items()} == {k: sorted(map(str, out[k].collect())) for k in ("ingredients", "additional_ndc_codes")}
        return {k: sorted(map(str, v.collect())) if k != "bodies" else v for k, v in out.items()}

    whole, cut = found(10**9), found(0)
    assert (whole.pop("bodies"), cut.pop("bodies")) == (5, 0)
    assert cut == whole
    assert all(whole.values()) and len(whole["quarantine"]) == 5


def test_texts_of_labels_are_read_to_be_cut_only(spark, tmp_path):
    """xml_load, xml_views: a text may be very long; once it is parsed and cut, no table reads it, and both cuts are one."""
    parse(spark.createDataFrame([(label("a", nest(9)),), (label("b", BODY),), ("<html/>",), (None,)], "xml string")).write.parquet(f"file://{tmp_path}/parsed")
    parsed = spark.read.parquet(f"file://{tmp_path}/parsed")
    read = lambda df: re.findall(r"FileScan parquet \[([^\]]*)\]", df._jdf.queryExecution().executedPlan().toString())
    assert read(parsed) and all("xml#" in x for x in read(parsed))
    assert not any("xml#" in x for x in read(D.documents(parsed)))
    cut = D.pieces(parsed)
    for df in (D.products(parsed, cut), D.all_sections(parsed, cut)):
        assert read(df) and not any("xml#" in x for x in read(df))
    assert D.all_sections(parsed, cut).where("document_id = 'a'").count() == 9
    assert sorted(e for row in D.documents(parsed).where("not success").collect() for e in row.processing_errors) == ["no readable text", "not a label document", "not a label document"]


def test_written_sections_come_back(spark):
    """All depths; parents that are missing or in another label make roots; a circle is cut once and reported."""
    from labelmill.sources.label_xml import section_trees, write_labels

    parent = {f"c{k}": f"c{k - 1}" if k else None for k in range(45)} | {"o": "nowhere", "p": "o", "x": "other"}
    parent |= {"l1": "l3", "l2": "l1", "l3": "l2", "tail": "l2", "self": "self"}
    rows = [(i, "a", p) for i, p in parent.items()] + [("other", "b", None)]
    secs = spark.createDataFrame(rows, "id string, spl_id string, parent_section_id string").selectExpr(
        "*", "'34067-9' loinc_code", "concat('<', id) section_title", "concat('a &lt; ', id) section_text", "1 section_order", "date'2020-01-02' effective_time",
    )
    meds = spark.sql("""select spl_id, 'set' set_id, 1 version_number, date'2020-01-01' effective_date, 'B' brand_name, 'G' generic_name, 'M' manufacturer, '1' ndc_code,
        'T' product_form, 'active' marketing_status, date'2020-01-01' marketing_date_start, '34391-3' document_code from values ('a'), ('b') t(spl_id)""")
    drugs = spark.sql("""select '1' id, 'a' spl_id, 'active' ingredient_type, 'S' substance_name, 'U' unii_code, 1.0 strength_numerator, 'mg' strength_numerator_unit,
        1.0 strength_denominator, '1' strength_denominator_unit""")
    found = D.all_sections(parse(write_labels(meds, drugs, secs).select("xml"))).where("not section_id like '%-product'").collect()
    want = parent | {"o": None, "x": None, "l1": None, "self": None, "other": None}
    assert {r.section_id: r.parent_section_id for r in found} == want and len(found) == len(want)
    assert max(r.depth for r in found) == 44
    assert {r.spl_id: list(r.cut) for r in section_trees(secs).collect()} == {"a": ["l1", "self"], "b": []}
