"""Value tables of the column functions."""

import html

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labelmill.functions import clinical, dates, indication, ingredient, ndc, text, units
from labelmill.functions.unitseg import common_quantity, read_number, segment

NDC = [
    ("12345-678-90", True, "12345-6789-0"), ("1234-5678-90", True, "12345-6789-0"), ("1234567890", True, "12345-6789-0"), ("63736-044", True, "63736-044"),
    ("123456789", False, None), ("invalid-ndc", False, None), ("", False, None), (None, False, None), ("12345678901", True, None),
    ("12345-678-901", True, None), ("1111111111", False, None), ("NDC: 12345-6789-0", True, "12345-6789-0"), ("0000012345", False, None),
]
DATES = [
    ("20240315", "2024-03-15"), ("2024-03-15", "2024-03-15"), ("03/15/2024", "2024-03-15"), ("March 15, 2024", "2024-03-15"), ("2024-03-15T10:30:00", "2024-03-15"),
    ("20240315103000", "2024-03-15"), ("25/12/2024", "2024-12-25"), ("03/04/2024", "2024-03-04"), ("20240230", None), ("", None), (None, None), ("9/1/2024", "2024-09-01"),
    ("first 2024-01-15, then 20241201", "2024-12-01"),
]
UNITS = [
    ("mcg", "ug", "mass"), ("mL", "mL", "volume"), ("tablet", "{tablet}", "dose_form"), ("mg/mL", "mg/mL", "ratio"), ("mcg/kg", "ug/kg", "ratio"), ("IU", "[IU]", "dose_form"),
    ("unit", "U", "dose_form"), ("mg per tablet", "mg/{tablet}", "ratio"), ("foo", None, None), (None, None, None), ("%", "%", "concentration"), (" Hours ", "h", "time"),
]


@pytest.mark.parametrize("raw, valid, normal", NDC)
def test_ndc(one, raw, valid, normal):
    assert one(ndc.is_valid_ndc, raw) is valid
    assert one(ndc.normalize_ndc, raw) == normal


def test_ndc_in_text(one):
    assert one(ndc.extract_ndcs, "see 12345-678-90 and NDC 98765-432-10, again 12345-678-90") == ["12345-6789-0", "98765-4321-0"]
    assert one(ndc.extract_ndcs, None) == []
    parts = one(ndc.ndc_components, "12345-678-90")
    assert (parts.labeler, parts.product, parts.package) == ("12345", "6789", "0")
    assert one(ndc.ndc_components, "63736-044") is None
    assert one(ndc.is_valid_labeler, "00000") is False


@pytest.mark.parametrize("raw, iso", DATES)
def test_dates(one, raw, iso):
    assert one(dates.normalize_date, raw) == iso


def test_date_checks(one):
    as_of = F.lit("2024-01-01").cast("date")
    assert one(dates.is_iso_date, "2024-02-30") is False
    assert one(lambda c: dates.is_future_date(c, as_of), "2030-01-01") is True
    assert one(lambda c: dates.is_reasonable_drug_date(c, as_of), "1949-01-01") is False
    assert one(lambda c: dates.is_reasonable_drug_date(c, as_of), None) is False


@pytest.mark.parametrize("raw, ucum, category", UNITS)
def test_units(one, raw, ucum, category):
    assert one(units.normalize_unit, raw) == ucum
    assert one(lambda c: units.unit_category(units.normalize_unit(c)), raw) == category


def test_quantity(one):
    assert one(units.quantity_value, "take 2.5 mg twice") == 2.5
    assert one(units.quantity_unit, "take 2.5 mg twice") == "mg"
    assert one(units.quantity_value, None) is None
    assert one(units.simple_unit, "µg") == "µg"
    assert one(units.simple_unit, "Micrograms") == "mcg"
    assert one(units.simple_unit, None) == ""
    assert one(lambda a, b, c, d: units.ucum_expression(a, b, c, d), "5", "mg", "2", "ml") == "5.0 mg/2.0 mL"
    assert one(lambda a, b, c, d: units.ucum_expression(a, b, c, d), "5", "mg", "1", "ml") == "5.0 mg/mL"


def test_clean_text(one):
    assert one(text.clean_clinical_text, "<p>This is a <b>test</b> with <em>markup</em>.</p>") == "This is a test with markup."
    assert one(text.plain_text, "<p>This is a <b>test</b> with <em>markup</em>.</p>") == "This is a test with markup ."
    assert one(text.clean_clinical_text, "•   first &amp;lt; x") == "• first < x"
    assert one(text.clean_clinical_text, None) == ""
    assert one(text.plain_text, "1. one\n2. two") == "one two"
    assert one(text.has_meaningful_content, "one two three four") is True
    assert one(text.has_meaningful_content, None) is False
    assert one(text.section_text, " \n ") is None


@settings(max_examples=25, deadline=None)
@given(t=st.text(max_size=40))
def test_unescape_is_html(spark, t):
    entities = t + "&eacute;&#65;&copy;"
    df = spark.createDataFrame([(entities,)], "t string")
    want = entities
    for e, s in text.ENTITIES:
        want = want.replace(e, s)
    assert df.select(text.decode_all_entities(F.col("t")).alias("v")).first().v == html.unescape(want)


@settings(max_examples=20, deadline=None)
@given(t=st.text(alphabet="ab <>&;p/\n•-1.", max_size=30))
def test_section_text_is_idempotent(spark, t):
    df = spark.createDataFrame([(t,)], "t string").select(text.section_text(F.col("t")).alias("a"))
    row = df.select("a", text.section_text(F.col("a")).alias("b")).first()
    assert row.a == row.b


def test_substances(one):
    assert one(ingredient.normalize_substance, " mineral  oil (UNII: ABC123)") == "MINERAL OIL"
    assert one(ingredient.normalize_substance, "aspirin [USP]") == "ASPIRIN"
    assert one(ingredient.normalize_unii, "npb7a7874u ") == "NPB7A7874U"
    assert one(ingredient.normalize_unii, "short") is None
    assert [one(ingredient.is_valid_substance, x) for x in ("a", "12 3", "--", "oil", None)] == [False, False, False, True, False]
    assert one(ingredient.ingredient_type, "actim") == "active"


def test_indications(one):
    assert one(indication.indication_type, "Helps prevent flu") == "prevention"
    assert one(indication.condition_name, "treats motion sickness") == "motion sickness"
    assert one(indication.condition_name, "  ") is None
    assert one(indication.population, "for adults and children 6 years and older").startswith("Age restriction found: adults and children 6")
    assert one(indication.population, "children and adults") == "Children and adults"
    assert one(indication.population, "dogs") is None


def test_clinical(one):
    found = one(clinical.dosages, "take 2 tablets 3 times per day")
    assert [(d.amount, d.unit, d.frequency, d.frequency_unit) for d in found] == [("2", "tablet", "3", "day")] * 2
    assert one(clinical.dosages, None) == []
    assert one(clinical.warning_items, "intro text here\n• first warning item\n2. short\n* second warning item") == ["intro text here", "first warning item", "second warning item"]
    assert one(clinical.contraindications, "Do not use if pregnant. Avoid wine if drowsy.") == ["Do not use if pregnant", "Avoid wine if drowsy"]
    assert one(clinical.keywords, "Ask a Doctor before a dose; side effect") == ["doctor", "dose", "side effect"]
    assert [one(clinical.syllables, w) for w in ("make", "the", "table", "rhythm", "b")] == [1, 1, 1, 1, 1]
    ease = one(clinical.reading_ease, "")
    assert (ease.n_words, ease.grade) == (0, 0.0)
    assert one(clinical.expand_abbreviations, "take PRN po") == "take as needed by mouth"
    assert one(clinical.section_type, "34071-1") == "WARNINGS"
    assert one(clinical.strategy, "unknown") == "GENERIC"


@pytest.mark.parametrize(
    "kind, raw, want",
    [
        ("WARNINGS", "warning: serious harm\n1. one", "WARNING: SERIOUS harm\n• one"),
        ("INDICATIONS_USAGE", "x is indicated for pain, 2tablet", "x is used to treat pain, 2 tablet"),
        ("DO_NOT_USE", "do not use if you are ill", "DO NOT USE \nif you are ill"),
        ("ASK_DOCTOR", "ask if you have pain", "ask \n• if you have pain"),
        ("WHEN_USING", "please do not drive", "please \n• do not drive"),
        ("STOP_USE", "Stop use now", "STOP USE now"),
        (None, "plain  text", "plain text"),
        (None, " a\n \t\nb\n - c\n *d \u2022e\n\n\n\u2022   f ", "a\n\nb\n - c\n *d \u2022 e\n\u2022 f"),
        ("ACTIVE_INGREDIENT", "5 MG.x 2 unit.y 3 iu.z", "5 mgx 2 unitsy 3 IUz"),
        (None, "a &alpha; &#8211; &#xb5; &amp;lt; &nothing; & b", "a \u03b1 \u2013 \u00b5 &lt; &nothing; & b"),
    ],
)
def test_rewrites(one, kind, raw, want):
    assert one(clinical.clinical_text, raw, kind) == want


STRENGTHS = [
    ((5, "thousand IU / 5 ml", None, None), 1e6, "iu/volume"), ((None, "0,75% w/w", None, None), 0.0075, "mass/mass"), ((None, "250mg./100milliliter", None, None), 2.5, "mass/volume"),
    ((4, "percent w/v", None, None), 40.0, "mass/volume"), ((8, "µg", 2, "{tablet}"), 4e-6, "mass/piece"), ((1, "MIU", None, None), 1e6, "iu/piece"), ((1, "MG", None, None), 1e-3, "mass/piece"),
    ((None, "288 mcg per 72 hr", None, None), 4e-6, "mass/time"), ((1, "g", 1, "d"), 1 / 24, "mass/time"), ((None, "6,000 milligrams per liter", None, None), 6.0, "mass/volume"),
    ((2, "mg/m2", None, None), 0.002, "mass/length2"), ((1, "mg", 1, "1"), 0.001, "mass/piece"), ((3, "mEq", None, None), 0.003, "eq/piece"), ((1, "[iU]", 1, "millilitre"), 1000.0, "iu/volume"),
]


@pytest.mark.parametrize("strength, value, kind", STRENGTHS)
def test_common_quantity(strength, value, kind):
    got = common_quantity(*strength)
    assert got[1] == kind and got[0] == pytest.approx(value)


@pytest.mark.parametrize("strength", [(None, "mg", None, None), (1, None, None, None), (1, "q.s.", None, None), (None, "trace", None, None), (1, "  ", 1, "mL"), (1, "mg", 0, "mL"), (2, "3 mg", None, None)])
def test_unreadable_quantity(strength):
    assert common_quantity(*strength) is None


def test_numbers():
    assert [read_number(x) for x in ("1,000", "0,5", "1,25", "1,000.5", "12.", "1.2.3")] == [1000.0, 0.5, 1.25, 1000.5, 12.0, None]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=15))
def test_segment_never_fails(t):
    segment(t)
    segment(t, "den")


def test_substance_tails(one):
    """An ending counts only after white space."""
    assert one(ingredient.normalize_substance, "a b (UNII: X1)") == "A B"
    assert one(ingredient.normalize_substance, "x(UNII: X1)") == "X(UNII: X1)"
    assert one(ingredient.normalize_substance, "x [INN]") == "X"
    assert one(ingredient.normalize_substance, None) is None
