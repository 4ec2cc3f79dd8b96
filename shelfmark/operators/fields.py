"""Field extraction from raw HTML: page to sixteen text columns.

Each field is a chain: the labelled list item of the page, a class the site
used at one time, a class of its older templates, then MISSING. The texts come
from one parse per page (``functions.html``); the chains are expressions.
"""

from __future__ import annotations

from dataclasses import astuple, dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfmark.functions.html import Page, Rule, match_rules
from shelfmark.functions.text import after_last, blank_to_null, given, or_missing, reasons, strip
from shelfmark.operators import clean
from shelfmark.schema import RAW_FIELDS


@dataclass(frozen=True)
class SiteProfile:
    """Labels and class names of one site. Fixed values, equal to the site's.

    ``legacy_sku`` is the site's own class name for the product code in its
    older templates; set it for the site at hand.
    """

    title_box: str = "header_wishlist"
    units_box: str = "daban"
    sale_price: str = "current-price ProductPrice"
    list_price: str = "original-price ComparePrice"
    sku: str = "sku-number"
    breadcrumb: str = "breadcrumb-small"
    description_id: str = "protab0"
    legacy_value: str = "field-item even"
    isbn_label: str = "ISBN"
    authors_label: str = "Tác giả"
    audience_label: str = "Đối tượng"
    size_label: str = "Khuôn Khổ"
    pages_label: str = "Số trang"
    binding_label: str = "Định dạng"
    weight_label: str = "Trọng lượng"
    series_label: str = "Bộ sách"
    authors_class: str = "tacgia-class"
    audience_class: str = "doituong-class"
    size_class: str = "khuonkho-class"
    series_class: str = "bosach-class"
    legacy_sku: str = "field-name-field-product-sku"
    legacy_isbn: str = "field-name-field-product--isbn"
    legacy_authors: str = "field-name-field-product-tacgia"
    legacy_audience: str = "field-name-field-product-dotuoi"
    legacy_size: str = "field-name-field-product-khuonkho"
    legacy_pages: str = "field-name-field-product-sotrang"
    legacy_binding: str = "field-name-field-product-loaibia"
    legacy_weight: str = "field-name-field-product-trongluong"
    legacy_series: str = "field-name-field-product-tax-bosach"


def _child_texts(page: Page, box: str, tag: str, whole: bool = True) -> list[str]:
    """Own texts of ``tag`` elements whose parent has the class value ``box``."""
    hits = []
    for i in page.tagged(tag):
        value = page.value(page.parents[i], "class")
        if value == box if whole else box in value:
            hits += page.own[i]
    return hits


def _class_texts(page: Page, tag: str, value: str) -> list[str]:
    """Own texts of ``tag`` elements with exactly this class value."""
    hits = [i for i in page.tagged(tag) if page.value(i, "class") == value]
    return [t for i in hits for t in page.own[i]]


def _squeezed(page: Page, name: str) -> list[str]:
    """Run-together text of every element with a class."""
    return [page.squeezed(i) for i in page.classed(name)]


def _legacy(page: Page, name: str, value: str) -> list[str]:
    """Value element of the first older-template field block."""
    blocks = page.classed(name)[:1]
    return [page.squeezed(i) for b in blocks for i in page.classed(value, b)[:1]]


def _labelled(page: Page, label: str) -> list[int]:
    """List items whose first own text contains the label."""
    return [i for i in page.tagged("li") if page.own[i] and label in page.own[i][0]]


def _item_texts(page: Page, label: str) -> list[str]:
    return [t for i in _labelled(page, label) for t in page.own[i]]


def _exact_item(page: Page, label: str) -> list[str]:
    """List items that hold the label and nothing else."""
    return [label for i in page.tagged("li") if page.texts(i) == [label]]


def _once(lists: list[list[int]]) -> list[int]:
    """Elements of several lists, each once, in document order."""
    return sorted({i for hits in lists for i in hits})


def _item_links(page: Page, label: str, direct: bool = False) -> list[str]:
    """Texts of the links inside labelled list items."""
    links = _once([page.tagged("a", i) for i in _labelled(page, label)])
    if direct:
        items = set(_labelled(page, label))
        links = [a for a in links if page.parents[a] in items]
    return [t for a in links for t in page.own[a]]


def _isbn(page: Page, label: str) -> list[str]:
    items = [i for i in page.tagged("li") if label in "".join(page.texts(i))]
    strong = _once([page.tagged("strong", i) for i in items])
    return [t for s in strong for t in page.own[s]]


def _second_crumb(page: Page, box: str) -> list[str]:
    hits = []
    for b in page.tagged("div"):
        if page.value(b, "class") == box:
            links = [a for a in page.tagged("a", b) if page.parents[a] == b]
            hits += [t for a in links[1:2] for t in page.own[a]]
    return hits


def _under_id(page: Page, element_id: str) -> list[str]:
    return [t for i in page.with_id(element_id) for t in page.texts(i)]


def product_rules(site: SiteProfile) -> dict[str, Rule]:
    """Texts to collect from a product page, by name of the raw column."""
    legacy = partial(_legacy, value=site.legacy_value)
    return {
        "title": partial(_child_texts, box=site.title_box, tag="h1"),
        "units": partial(_class_texts, tag="div", value=site.units_box),
        "sale": partial(_class_texts, tag="span", value=site.sale_price),
        "list": partial(_child_texts, box=site.list_price, tag="s", whole=False),
        "sku": partial(_squeezed, name=site.sku),
        "sku_old": partial(legacy, name=site.legacy_sku),
        "isbn": partial(_isbn, label=site.isbn_label),
        "isbn_old": partial(legacy, name=site.legacy_isbn),
        "authors": partial(_item_links, label=site.authors_label),
        "authors_alt": partial(_squeezed, name=site.authors_class),
        "authors_old": partial(legacy, name=site.legacy_authors),
        "audience": partial(_item_links, label=site.audience_label),
        "audience_alt": partial(_squeezed, name=site.audience_class),
        "audience_old": partial(legacy, name=site.legacy_audience),
        "size": partial(_item_texts, label=site.size_label),
        "size_alt": partial(_squeezed, name=site.size_class),
        "size_old": partial(legacy, name=site.legacy_size),
        "pages": partial(_item_texts, label=site.pages_label),
        "pages_alt": partial(_exact_item, label=site.pages_label),
        "pages_old": partial(legacy, name=site.legacy_pages),
        "binding": partial(_item_texts, label=site.binding_label),
        "binding_alt": partial(_exact_item, label=site.binding_label),
        "binding_old": partial(legacy, name=site.legacy_binding),
        "weight": partial(_item_texts, label=site.weight_label),
        "weight_alt": partial(_exact_item, label=site.weight_label),
        "weight_old": partial(legacy, name=site.legacy_weight),
        "series": partial(_item_links, label=site.series_label, direct=True),
        "series_alt": partial(_squeezed, name=site.series_class),
        "series_old": partial(legacy, name=site.legacy_series),
        "category": partial(_second_crumb, box=site.breadcrumb),
        "description": partial(_under_id, element_id=site.description_id),
    }


def match_pages(
    pages: DataFrame, rules: dict[str, Rule], markers: tuple[str, ...]
) -> DataFrame:
    """One parse per page: the html column becomes one array column per rule."""
    texts = [T.StructField(name, T.ArrayType(T.StringType())) for name in rules]
    kept = [f for f in pages.schema.fields if f.name != "html"]
    return pages.mapInArrow(
        partial(match_rules, rules=rules, markers=markers), T.StructType(kept + texts)
    )


def _first(name: str) -> str:
    return f"try_element_at({name}, 1)"


def _chain(name: str) -> str:
    """Alternate text if its element exists, else the older template's text."""
    return f"coalesce({_first(f'{name}_alt')}, {_first(f'{name}_old')})"


def _joined(name: str) -> str:
    return f"array_join({name}, ', ')"


def extract_fields(pages: DataFrame, site: SiteProfile = SiteProfile()) -> DataFrame:
    """Sixteen text columns per page, and ``reasons`` for texts that cannot be read.

    ``pages`` has an ``html`` column; its other columns are kept. A text that
    cannot be read gives null and a reason; the row stays.
    """
    keys = [c for c in pages.columns if c != "html"]
    texts = match_pages(pages, product_rules(site), astuple(site))
    size = clean.size_text(blank_to_null(_first("size")), site.size_label)
    other_size = clean.size_text(_chain("size"))
    other_authors = (
        f"CASE WHEN size(authors_alt) > 0 THEN {_joined('authors_alt')} "
        f"ELSE {_first('authors_old')} END"
    )
    other_pages = (
        f"coalesce({clean.page_text(_first('pages_alt'))}, "
        f"{clean.page_text(_first('pages_old'), labelled=False)})"
    )
    other_binding = (
        f"coalesce({after_last(_first('binding_alt'), ':')}, {_first('binding_old')})"
    )
    other_weight = (
        f"coalesce({clean.without_unit(after_last(_first('weight_alt'), ':'))}, "
        f"{clean.without_unit(_first('weight_old'))})"
    )
    fields = {
        "title": clean.text(_first("title")),
        # Linked authors that strip to nothing stay empty.
        "authors": f"CASE WHEN size(authors) > 0 THEN {strip(_joined('authors'))} "
        f"ELSE {or_missing(other_authors)} END",
        "units_sold": clean.units_sold(_first("units")),
        "sale_price": clean.price(_first("sale")),
        "list_price": clean.price(_first("list")),
        "sku": given(f"coalesce({_first('sku')}, {_first('sku_old')})"),
        "isbn": clean.text_chain(_first("isbn"), _first("isbn_old")),
        "audience": clean.audience(_first("audience"), _chain("audience")),
        "length_cm": clean.dimension("_parts", 2),
        "width_cm": clean.dimension("_parts", 1),
        "page_count": clean.page_count(_first("pages"), other_pages),
        "binding": clean.binding(_first("binding"), other_binding),
        "weight_g": clean.weight(_first("weight"), other_weight),
        "series": clean.text_chain(_first("series"), _chain("series")),
        "category": clean.text(_first("category")),
        "description": strip("array_join(description, ' ')"),
    }
    parts = clean.size_parts(f"coalesce({size}, {other_size})")
    return (
        texts.selectExpr("*", f"{parts} AS _parts")
        .selectExpr(*keys, *[f"{fields[f]} AS {f}" for f in RAW_FIELDS])
        .selectExpr("*", f"{reasons(clean.UNREADABLE)} AS reasons")
    )
