"""Field extraction from hand-written pages, and the page scan itself."""

import pytest
from pyspark.sql import functions as F

from shelfmark.functions.html import Page
from shelfmark.operators.fields import SiteProfile, extract_fields
from shelfmark.operators.links import in_domains, normal_url, tile_links
from shelfmark.schema import MISSING, RAW_FIELDS

OLD = (
    '<div class="field {0} x"><div class="field-items"><div class="field-item even">{1}</div>'
    "</div></div>"
)


def extract(spark, html, site=SiteProfile()):
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    return extract_fields(pages, site).first()


def test_current_template(spark):
    row = extract(
        spark,
        """<html><body><div class="breadcrumb-small"><a>Home</a> / <a> Truyện </a><a>c</a></div>
        <div class="header_wishlist"><h1> Tên &amp; tuổi </h1><h1>second</h1></div>
        <div class="daban"> Đã bán: 1 25 </div>
        <span class="current-price ProductPrice">25,000₫</span>
        <span class="a original-price ComparePrice b"><s> 30,500₫</s></span>
        <p class="big sku-number"> S <b>1</b> </p>
        <ul><li>ISBN (13): <p><strong> 978 </strong></p>
        <li>Tác giả: <a> A</a>, <a>B </a><li>Đối tượng: <a>Tuổi 1 (x)</a><a>no</a>
        <li>Khuôn Khổ: 13 x 19 cm<li>Số trang: ~128 trang<li>Định dạng: bìa mềm
        <li>Trọng lượng: 250 gram<li>Bộ sách: <b><a>deep</a></b><a>S</a></ul>
        <div id="protab0"><p>one<br>two</p><div>three<div>four</div></div> </div>five""",
    )
    assert row.asDict() == {
        "page_id": 1,
        "title": "Tên & tuổi",
        "units_sold": "25",
        "sale_price": "25000",
        "list_price": "30500",
        "sku": "S1",
        "isbn": "978",
        "authors": "A, B",
        "audience": "Tuổi 1",
        "width_cm": "13",
        "length_cm": "19",
        "page_count": "128",
        "binding": " bìa mềm",
        "weight_g": "250",
        "series": "S",
        "category": "Truyện",
        "description": "one two three four",
        "reasons": [],
    }


def test_authors_keep_their_inner_blanks(spark):
    row = extract(spark, "<li>Tác giả: <a> A </a><a> B </a></li>")
    assert row.authors == "A ,  B"


def test_older_classes(spark):
    row = extract(
        spark,
        '<i class="tacgia-class">A</i><i class="tacgia-class"> B</i><i class="doituong-class">'
        'Tuổi 2 (y)</i><i class="khuonkho-class">18-25cm</i><i class="bosach-class"> S </i>',
    )
    assert (row.authors, row.audience, row.series) == ("A, B", "Tuổi 2", "S")
    assert (row.width_cm, row.length_cm) == ("18", "25")


def test_oldest_template(spark):
    site = SiteProfile(legacy_sku="field-code")
    blocks = [
        ("field-code", " K1 "),
        (site.legacy_isbn, "978"),
        (site.legacy_authors, "A"),
        (site.legacy_audience, "Tuổi 3"),
        (site.legacy_size, "21 cm"),
        (site.legacy_pages, "~40 trang"),
        (site.legacy_binding, "bìa cứng"),
        (site.legacy_weight, "1.250 gram"),
        (site.legacy_series, "S"),
    ]
    row = extract(spark, "".join(OLD.format(*b) for b in blocks), site)
    assert (row.sku, row.isbn, row.authors, row.audience) == ("K1", "978", "A", "Tuổi 3")
    assert (row.width_cm, row.length_cm, row.page_count) == ("21", MISSING, "40")
    assert (row.binding, row.weight_g, row.series) == ("bìa cứng", "1.250", "S")


@pytest.mark.parametrize("html", [None, "", "<p>nothing here</p>", "plain <3 text"])
def test_page_without_fields(spark, html):
    row = extract(spark, html)
    given = {"units_sold": "có", "description": ""}
    assert {f: row[f] for f in RAW_FIELDS} == {f: given.get(f, MISSING) for f in RAW_FIELDS}


def test_unreadable_texts_keep_the_row(spark):
    row = extract(
        spark,
        '<div class="daban"> </div><li>Khuôn Khổ: 3 x 4 x 5</li><li>Trọng lượng: </li>',
    )
    assert row.reasons == ["unreadable_units", "unreadable_size", "unreadable_weight"]
    assert (row.units_sold, row.width_cm, row.length_cm, row.weight_g) == (None,) * 4


def test_blank_label_falls_to_exact_item(spark):
    row = extract(spark, "<li>Số trang: </li><li>Số trang</li><li>Định dạng</li>")
    assert (row.page_count, row.binding) == ("Số", "Định dạng")


def test_label_written_with_entities(spark):
    row = extract(spark, "<li>T&aacute;c giả: <a>A</a></li>")
    assert row.authors == "A"


def test_scan_of_untidy_markup():
    page = Page(
        '<!doctype html><!-- <p>no</p> --><P Class=x>a < b &amp; <b>c</p>d</b>'
        "<script>if (a < b) { \"</p>\" }</script><img src='>'><a href=\"?a=1&amp;b=2\" href=z>e"
    )
    p = page.tagged("p")[0]
    assert (page.value(p, "class"), page.texts(p)) == ("x", ["a < b & ", "c"])
    assert page.own[0] == ["d"]
    assert page.own[page.tagged("script")[0]] == ['if (a < b) { "</p>" }']
    assert [page.value(a, "href") for a in page.tagged("a")] == ["?a=1&b=2"]
    assert page.own[page.tagged("a")[0]] == ["e"]


def test_tile_links(spark):
    html = (
        '<a href="/out">x</a><div class="col product-item"><div><a href="/a">x</a>'
        '<div class="product-item"><a href="/b"></a></div><a href=""></a><a>y</a></div></div>'
        '<div class="product-items"><a href="/no">x</a></div>'
    )
    pages = spark.createDataFrame([(7, html)], "page_id int, html string")
    rows = tile_links(pages, "http://h").orderBy("pos").collect()
    assert [(r.page_id, r.pos, r.url) for r in rows] == [(7, 0, "http://h/a"), (7, 1, "http://h/b")]


def test_domains_and_urls(spark):
    urls = ["http://a.com/x#f", "https://B.a.com:8080/", "http://na.com/", "not a url", None]
    url = F.col("url")
    rows = (
        spark.createDataFrame([(u,) for u in urls], "url string")
        .select(in_domains(url, ["a.com"]).alias("inside"), normal_url(url).alias("n"))
        .collect()
    )
    assert [r.inside for r in rows] == [True, True, False, False, False]
    assert rows[0].n == "http://a.com/x" and rows[1].n == "https://B.a.com:8080"
