"""Clean-up of the texts a page gives for its fields.

SQL text in, SQL text out. Each function takes the text of the page's labelled
node and, where the field has one, the text of its fallback nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfmark.functions.text import (
    after_last,
    before_first,
    blank_to_null,
    first_token,
    given,
    last_token,
    money,
    or_missing,
    reasons,
    remove,
    strip,
)
from shelfmark.schema import RAW_FIELDS

# Label and words around a size, a page count and a weight.
SIZE_LABEL = "Khuôn Khổ"
SIZE_UNIT = "cm"
PAGE_WORDS = ("~", "trang/cuốn", "trang")
WEIGHT_UNIT = "gram"

# Texts that cannot be read: the field is null, the row stays, with a reason.
UNREADABLE = [
    ("unreadable_units", "units_sold IS NULL"),
    ("unreadable_size", "width_cm IS NULL"),
    ("unreadable_weight", "weight_g IS NULL"),
]


def text(c: str) -> str:
    """A plain field: stripped, MISSING when the node is absent."""
    return strip(given(c))


def text_chain(first: str, *others: str) -> str:
    """A field with fallbacks; blank counts as absent."""
    return or_missing(strip(first), *others)


def units_sold(c: str) -> str:
    """Last token; the default marker is cut like any text. Null if blank."""
    return last_token(given(c))


def price(c: str) -> str:
    """Price without currency sign and commas."""
    return money(given(c))


def audience(first: str, *others: str) -> str:
    """Text before the bracket."""
    cut = [strip(before_first(c, "(")) for c in (strip(first), *others)]
    return or_missing(*cut)


def size_text(c: str, label: str = "") -> str:
    """Size without its label and unit (X9); null stays null."""
    return strip(remove(strip(c), *([f"{label}:"] if label else []), SIZE_UNIT))


def size_parts(size: str) -> str:
    """Array of the parts around ``x``, else around ``-``."""
    size = given(size)
    return (
        f"CASE WHEN contains({size}, 'x') THEN split({size}, 'x', -1) "
        f"ELSE split({size}, '-', -1) END"
    )


def dimension(parts: str, n: int) -> str:
    """Part 1 is the width, part 2 the length. Three parts cannot be read: null."""
    part = or_missing(strip(f"try_element_at({parts}, {n})"))
    return f"CASE WHEN size({parts}) <= 2 THEN {part} END"


def page_text(c: str, labelled: bool = True) -> str:
    """Page count text without the words around it (X11)."""
    plain = remove(strip(c), *PAGE_WORDS)
    return strip(after_last(plain, ":") if labelled else plain)


def page_count(first: str, *others: str) -> str:
    return or_missing(page_text(first), *others)


def binding(first: str, *others: str, trim: bool = False) -> str:
    """Text after the last colon; its leading blank stays unless ``trim``."""
    value = after_last(strip(first), ":")
    return or_missing(strip(value) if trim else value, *others)


def without_unit(c: str) -> str:
    """Weight text of the fallback nodes."""
    return strip(remove(c, WEIGHT_UNIT))


def weight(first: str, other: str = "NULL") -> str:
    """First token after the last colon; null if the label has nothing after it."""
    token = first_token(after_last(strip(first), ":"))
    return f"CASE WHEN {first} <> '' THEN {token} ELSE {or_missing(other)} END"


def clean_record(raw: DataFrame) -> DataFrame:
    """Page texts to the sixteen fields of a record.

    Input columns end in ``_text``. Other columns are kept in front; ``reasons``
    lists unreadable texts.
    """
    fields = {
        "title": text("title_text"),
        "authors": text("authors_text"),
        "units_sold": units_sold("units_text"),
        "sale_price": price("sale_text"),
        "list_price": price("list_text"),
        "sku": text("sku_text"),
        "isbn": text_chain("isbn_text"),
        "audience": audience("audience_text"),
        "length_cm": dimension("_parts", 2),
        "width_cm": dimension("_parts", 1),
        "page_count": page_count("pages_text"),
        "binding": binding("binding_text"),
        "weight_g": weight("weight_text"),
        "series": text_chain("series_text"),
        "category": text("category_text"),
        "description": strip("coalesce(description_text, '')"),
    }
    kept = [c for c in raw.columns if not c.endswith("_text")]
    parts = size_parts(size_text(blank_to_null("size_text"), SIZE_LABEL))
    return (
        raw.selectExpr("*", f"{parts} AS _parts")
        .selectExpr(*kept, *[f"{fields[f]} AS {f}" for f in RAW_FIELDS])
        .selectExpr("*", f"{reasons(UNREADABLE)} AS reasons")
    )


