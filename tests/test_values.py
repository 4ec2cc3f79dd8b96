"""Edge values: cleaning and coercion of single texts."""

import pytest
from pyspark.sql import types as T

from shelfmark.operators import clean
from shelfmark.operators.coerce import coerce, parse_typed
from shelfmark.schema import MISSING, RAW_FIELDS, RAW_SCHEMA

REJECT = "reject"

# text: v1 int, v1 double, v3 int, v3 double, v4 int, v5 pages, v5 weight, v5 sizes
COERCION = {
    "128": (128, 128.0, 128, 128.0, 128, 128, 128, 128.0),
    " 7 ": (7, 7.0, 7, 7.0, 7, 7, 0, 7.0),
    "12.5": (12, 12.5, 12, 12.5, 12, 0, 125, 12.5),
    "-5": (-5, -5.0, -5, -5.0, -5, 0, 0, 0.0),
    "-5.9": (-5, -5.9, -5, -5.9, -5, 0, 0, 0.0),
    "5.": (5, 5.0, 5, 5.0, 5, 0, 5, 5.0),
    ".5": (0, 0.5, 0, 0.5, 0, 0, 5, 0.5),
    "+.": (0, None, 0, 0.0, 0, 0, 0, 0.0),
    "+": (None, None, 0, 0.0, None, 0, 0, 0.0),
    "12d": (None, 12.0, 0, 12.0, None, 0, 0, 0.0),
    "0x10": (None, None, 0, 0.0, None, 0, 0, 0.0),
    MISSING: (None, None, 0, 0.0, None, 0, 0, 0.0),
    None: (0, 0.0, 0, 0.0, 0, 0, 0, 0.0),
    "": (None, None, 0, 0.0, None, 0, 0, 0.0),
    "1,5": (None, None, 0, 0.0, None, 0, 0, 0.0),
    "1.2.3": (None, None, 0, 0.0, None, 0, 123, REJECT),
    "1e3": (None, 1000.0, 0, 1000.0, None, 0, 0, 0.0),
    "2147483648": (None, 2147483648.0, 0, 2147483648.0, None, REJECT, REJECT, 2147483648.0),
    "1.250": (1, 1.25, 1, 1.25, 1, 0, 1250, 1.25),
    " 250": (250, 250.0, 250, 250.0, 250, 250, 0, 250.0),
    "\t8\n": (8, 8.0, 8, 8.0, None, 8, 0, 8.0),
    " Infinity": (None, float("inf"), 0, float("inf"), None, 0, 0, 0.0),
}
# Spark's trim removes plain blanks only, but the cast after it ignores more.
COERCION["\t8\n"] = (8, 8.0, 8, 8.0, 8, 8, 0, 8.0)


def _records(spark, texts):
    """One record per text, with the text in every numeric field."""
    numeric = {"page_count", "weight_g", "length_cm", "width_cm"}
    rows = []
    for i, text in enumerate(texts):
        fields = [text if f in numeric else "1" for f in RAW_FIELDS]
        rows.append((i, *fields))
    schema = T.StructType([T.StructField("n", T.IntegerType()), *RAW_SCHEMA.fields])
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def coerced(spark):
    texts = list(COERCION)
    records = _records(spark, texts).cache()
    return {
        policy: {texts[r.n]: r for r in coerce(records, policy).collect()}
        for policy in ("v1", "v3", "v4", "v5")
    }


@pytest.mark.parametrize("text", list(COERCION), ids=repr)
def test_policies(coerced, text):
    v1i, v1d, v3i, v3d, v4i, pages, grams, size = COERCION[text]
    one, three, four, five = (coerced[p][text] for p in ("v1", "v3", "v4", "v5"))
    assert (one.page_count, one.weight_g, one.length_cm) == (v1i, v1d, v1d)
    assert (three.page_count, three.weight_g, three.width_cm) == (v3i, v3i, v3d)
    assert (four.page_count, four.weight_g) == (v4i, v4i)
    assert one.reasons == three.reasons == four.reasons == []
    for value, field in ((pages, "page_count"), (grams, "weight_g"), (size, "width_cm")):
        if value == REJECT:
            assert f"unreadable_{field}" in five.reasons
        else:
            assert five[field] == value


def test_v1_absent_units_and_prices_stay_null(spark):
    row = spark.createDataFrame([(None,) * 16], RAW_SCHEMA)
    typed = coerce(row, "v1").first()
    assert (typed.units_sold, typed.sale_price, typed.list_price) == (None, None, None)
    assert (typed.page_count, typed.weight_g, typed.length_cm, typed.width_cm) == (0, 0, 0, 0)


@pytest.mark.parametrize(
    "units,price,bad",
    [
        ("5", "25,000", []),
        (" 5 ", " 1e3 ", []),
        ("1_000", ".5", []),
        (None, None, []),
        ("5.0", "1", ["unreadable_units_sold"]),
        (MISSING, MISSING, ["unreadable_units_sold", "unreadable_sale_price"]),
        ("1", "12d", ["unreadable_sale_price"]),
        ("1", "", ["unreadable_sale_price"]),
    ],
)
@pytest.mark.parametrize("policy", ["v3", "v5"])
def test_strict_units_and_prices(spark, policy, units, price, bad):
    values = {f: "1" for f in RAW_FIELDS} | {"units_sold": units, "sale_price": price}
    row = spark.createDataFrame([tuple(values[f] for f in RAW_FIELDS)], RAW_SCHEMA)
    assert coerce(row, policy).first().reasons == bad


def test_v2_loses_numbers_sent_as_text(spark):
    sent = [
        ('{"page_count": "128", "weight_g": "250", "sale_price": "5", "title": "t"}',),
        ('{"page_count": 128, "weight_g": 250, "sale_price": 5, "title": "t"}',),
        ('{"page_count": 12.5, "title": "t"}',),
    ]
    text, number, fraction = parse_typed(spark.createDataFrame(sent, "value string")).collect()
    assert (text.page_count, text.weight_g, text.sale_price, text.title) == (0, 0, None, "t")
    assert (number.page_count, number.weight_g, number.sale_price) == (128, 250, 5.0)
    assert (fraction.page_count, fraction.title) == (0, "t")


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        coerce(spark.createDataFrame([(None,) * 16], RAW_SCHEMA), "v9")


def _value(spark, sql, text):
    return spark.createDataFrame([(text,)], "c string").selectExpr(f"{sql} AS v").first().v


@pytest.mark.parametrize(
    "function,text,want",
    [
        (clean.units_sold, "Đã bán: 25", "25"),
        (clean.units_sold, "Đã bán:\n\t25\u00a0", "25"),
        (clean.units_sold, None, "có"),
        (clean.units_sold, " \n ", None),
        (clean.price, "25,000₫", "25000"),
        (clean.price, "1.200.000₫", "1.200.000"),
        (clean.price, None, MISSING),
        (clean.page_count, "Số trang: ~128 trang", "128"),
        (clean.page_count, "Số trang: 41 trang/cuốn", "41"),
        (clean.page_count, "Số trang:", MISSING),
        (clean.page_count, "Số trang", "Số"),
        (clean.page_count, None, MISSING),
        (clean.weight, "Trọng lượng: 250 gram", "250"),
        (clean.weight, "Trọng lượng: 1.250 gram", "1.250"),
        (clean.weight, "Trọng lượng:", None),
        (clean.weight, None, MISSING),
        (clean.audience, "Tuổi 1 (thiếu nhi)", "Tuổi 1"),
        (clean.audience, "(x)", MISSING),
        (clean.binding, "Định dạng: bìa mềm", " bìa mềm"),
        (clean.binding, "Định dạng:", MISSING),
        (clean.text, "\u3000a b\n", "a b"),
        (clean.text, "  ", ""),
        (clean.text_chain, "  ", MISSING),
    ],
)
def test_clean(spark, function, text, want):
    assert _value(spark, function("c"), text) == want


def test_binding_trimmed(spark):
    assert _value(spark, clean.binding("c", trim=True), "Định dạng: bìa mềm") == "bìa mềm"


@pytest.mark.parametrize(
    "text,width,length",
    [
        ("Khuôn Khổ: 13 x 19 cm", "13", "19"),
        ("18-25", "18", "25"),
        ("21 cm", "21", MISSING),
        ("13,5 x 20", "13,5", "20"),
        ("10-12 x 5", "10-12", "5"),
        ("x 20", MISSING, "20"),
        ("3 x 4 x 5", None, None),
        ("Khuôn Khổ: cm", MISSING, MISSING),
        (None, MISSING, MISSING),
    ],
)
def test_size(spark, text, width, length):
    parts = clean.size_parts(clean.size_text("c", clean.SIZE_LABEL))
    assert _value(spark, clean.dimension(parts, 1), text) == width
    assert _value(spark, clean.dimension(parts, 2), text) == length
