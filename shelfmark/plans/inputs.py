"""Catalogue inputs derived from the given tables.

The tables hold no scraped books, so Spark derives them from ``part``: one
dirty record per part, with absent, unreadable and repeated values, and from
these the HTML pages that would give them. Every input grows with its table.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.clean import clean_record
from shelfmark.operators.fields import SiteProfile
from shelfmark.operators.messages import publish_frame
from shelfmark.schema import RAW_FIELDS

# Page texts of a record, as SQL that both engines read. Every seventh record
# repeats the sku of the one three before it.
RAW_TEXTS = {
    "seq": "CAST(p_partkey AS BIGINT)",
    "sku_text": """CASE WHEN p_partkey % 97 = 0 THEN NULL
        WHEN p_partkey % 7 = 3 THEN concat('SKU', CAST(p_partkey - 3 AS STRING))
        ELSE concat(' SKU', CAST(p_partkey AS STRING), ' ') END""",
    "title_text": """CASE WHEN p_partkey % 211 = 5 THEN repeat(concat(p_name, ' '), 40)
        ELSE concat('  ', p_name, ' ') END""",
    "authors_text": """CASE WHEN p_partkey % 13 = 0 THEN NULL
        WHEN p_partkey % 5 = 0 THEN concat(p_brand, ', ', p_type) ELSE p_brand END""",
    "units_text": """CASE WHEN p_partkey % 17 = 0 THEN NULL
        ELSE concat('Đã bán: ', CAST(p_partkey % 300 AS STRING)) END""",
    "sale_text": """CASE WHEN p_partkey % 19 = 0 THEN NULL
        WHEN p_partkey % 29 = 0 THEN '1.200.000₫'
        ELSE concat(CAST(1 + p_partkey % 90 AS STRING), ',000₫') END""",
    "list_text": "concat(CAST(10 + p_partkey % 90 AS STRING), ',500₫')",
    "size_text": """CASE WHEN p_partkey % 41 = 7 THEN 'Khuôn Khổ: 3 x 4 x 5 cm' ELSE
        CASE p_partkey % 6 WHEN 0 THEN 'Khuôn Khổ: 13 x 19 cm'
        WHEN 1 THEN 'Khuôn Khổ: 14.5 x 20.5 cm' WHEN 2 THEN 'Khuôn Khổ: 18-25 cm'
        WHEN 3 THEN 'Khuôn Khổ: 21 cm' WHEN 4 THEN 'Khuôn Khổ: 13,5 x 20 cm' END END""",
    "pages_text": """CASE p_partkey % 5 WHEN 0 THEN 'Số trang: ~128 trang'
        WHEN 1 THEN concat('Số trang: ', CAST(p_size AS STRING), ' trang/cuốn')
        WHEN 2 THEN 'Số trang: 12.5' WHEN 3 THEN 'Số trang: nhiều' END""",
    "weight_text": """CASE WHEN p_partkey % 43 = 11 THEN 'Trọng lượng: ' ELSE
        CASE p_partkey % 4 WHEN 0 THEN 'Trọng lượng: 1.250 gram'
        WHEN 1 THEN concat('Trọng lượng: ', CAST(p_size * 10 AS STRING), ' gram')
        WHEN 2 THEN 'Trọng lượng: 250 gram' END END""",
    "binding_text": """CASE p_partkey % 3 WHEN 0 THEN 'Định dạng: bìa mềm'
        WHEN 1 THEN 'Định dạng: bìa cứng' END""",
    "audience_text": "concat('Tuổi ', CAST(p_size % 5 AS STRING), ' (thiếu nhi)')",
    "isbn_text": """CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE
        concat('978-604-2-', CAST(10000 + p_partkey AS STRING)) END""",
    "series_text": "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END",
    "category_text": "p_type",
    "description_text": "concat(p_name, ' ', p_type, ' ', p_brand)",
}
SENT = "CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END"
ROWS = 20_000  # parts of which one task makes records


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _texts(parts: DataFrame, sent: bool = False) -> DataFrame:
    texts = [f"{expr} AS {name}" for name, expr in RAW_TEXTS.items()]
    if sent:
        texts.append(f"{SENT} AS sent")
    return parts.selectExpr(*texts)


def _spread(rows: DataFrame) -> DataFrame:
    """The rows in tasks of about ``ROWS``, whatever their files and values are.

    A million parts are a few MB in one row group, which one task reads, while a
    record costs far more than its part: the parts are spread before they become
    texts. Few are left where they are.
    """
    tasks = ceil(rows.count() / ROWS)
    return rows.repartition(tasks) if tasks > 1 else rows


def raw_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page texts per part: ``seq`` and one text column per field."""
    return _texts(table(spark, sf_dir, "part"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned text records: ``seq``, sixteen fields, ``reasons``."""
    return clean_record(_texts(_spread(table(spark, sf_dir, "part"))))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as stored documents: id, fields, delivery flag."""
    rows = clean_record(_texts(_spread(table(spark, sf_dir, "part")), sent=True))
    return rows.select(F.col("seq").alias("doc_id"), *RAW_FIELDS, "sent")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as topic rows; ``offset`` is the record's place."""
    rows = records(spark, sf_dir).select(F.col("seq").alias("offset"), *RAW_FIELDS)
    return publish_frame(rows, keep=("offset",)).select(
        "key", "value", F.lit(0).alias("partition"), "offset"
    )


def _tag(open_tag: str, text: Column, close_tag: str) -> Column:
    """The element, or nothing where the text is null."""
    return F.coalesce(F.concat(F.lit(open_tag), text, F.lit(close_tag)), F.lit(""))


def _old_field(name: str, value: str, text: Column) -> Column:
    return _tag(
        f'<span class="field {name} clearfix"><span class="field-items"><span class="{value}">',
        text,
        "</span></span></span>",
    )


def _each(text: Column, open_tag: str, close_tag: str) -> Column:
    """One element per part of a comma-separated text."""
    return F.array_join(
        F.transform(
            F.split(text, ", "), lambda t: F.concat(F.lit(open_tag), t, F.lit(close_tag))
        ),
        " ",
    )


def product_pages(texts: DataFrame, site: SiteProfile = SiteProfile()) -> DataFrame:
    """HTML per record in one of the site's three templates: ``seq, url, html``.

    The table is a single small file, while scanning a page costs far more than
    moving its texts: the texts are spread before they become pages.
    """
    spark = texts.sparkSession
    tasks = max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    texts = texts.repartition(tasks, "seq")
    col = F.col
    value = lambda name, label: F.replace(
        col(name), F.lit(f"{label}:"), F.lit("")
    )
    head = F.concat(
        F.lit('<!DOCTYPE html><html><body><div class="breadcrumb-small"><a href="/">Trang</a>'),
        F.concat(F.lit("<a>"), "category_text", F.lit("</a></div>")),
        F.concat(
            F.lit(f'<div class="{site.title_box}"><h1>'), "title_text", F.lit("</h1></div>")
        ),
        _tag(f'<div class="{site.units_box}">', col("units_text"), "</div>"),
        _tag(f'<span class="{site.sale_price}">', col("sale_text"), "</span>"),
        _tag(f'<span class="{site.list_price}"><s>', col("list_text"), "</s></span>"),
    )
    foot = F.concat(
        F.lit(f'<div id="{site.description_id}"><div><p>'),
        F.replace("description_text", F.lit(" "), F.lit("</p><p>")),
        F.lit("</p></div></div><footer>&copy;</footer></body></html>"),
    )
    sku = _tag(f'<span class="box {site.sku}">', col("sku_text"), "</span>")
    items = F.concat(
        F.lit("<ul>"),
        _tag(f"<li>{site.isbn_label}: <strong>", col("isbn_text"), "</strong></li>"),
        _tag(f"<li>{site.authors_label}: ", _each(col("authors_text"), "<a>", "</a>"), "</li>"),
        _tag(f"<li>{site.audience_label}: <a>", col("audience_text"), "</a></li>"),
        *[
            _tag("<li>", col(f"{n}_text"), "</li>")
            for n in ("size", "pages", "binding", "weight")
        ],
        _tag(f"<li>{site.series_label}: <a>", col("series_text"), "</a></li>"),
        F.lit("</ul>"),
    )
    old = lambda name, text: _old_field(name, site.legacy_value, text)
    old_rest = F.concat(
        old(site.legacy_isbn, col("isbn_text")),
        old(site.legacy_pages, value("pages_text", site.pages_label)),
        old(site.legacy_binding, value("binding_text", site.binding_label)),
        old(site.legacy_weight, value("weight_text", site.weight_label)),
    )
    classes = F.concat(
        _each(F.coalesce("authors_text", F.lit("")), f'<a class="{site.authors_class}">', "</a>"),
        _tag(f'<span class="{site.audience_class}">', col("audience_text"), "</span>"),
        _tag(f'<span class="{site.size_class}">', value("size_text", site.size_label), "</span>"),
        _tag(f'<span class="{site.series_class}">', col("series_text"), "</span>"),
        old_rest,
    )
    oldest = F.concat(
        old(site.legacy_sku, col("sku_text")),
        old(site.legacy_authors, col("authors_text")),
        old(site.legacy_audience, col("audience_text")),
        old(site.legacy_size, value("size_text", site.size_label)),
        old(site.legacy_series, col("series_text")),
        old_rest,
    )
    body = (
        F.when(col("seq") % 3 == 0, F.concat(sku, items))
        .when(col("seq") % 3 == 1, F.concat(sku, classes))
        .otherwise(oldest)
    )
    html = F.concat(head, body, foot)
    return texts.select("seq", product_path().alias("url"), html.alias("html"))


def product_path() -> Column:
    return F.concat(F.lit("/products/"), F.col("seq").cast("string"))


TILES = 24


def listing_pages(texts: DataFrame) -> DataFrame:
    """Listing HTML, 24 tiles a page, some without an address: ``page_id, html``."""
    path = F.when(F.col("seq") % 10 == 9, F.lit("")).otherwise(product_path())
    tile = F.concat(
        F.lit('<div class="col product-item"><p><a href="'), path, F.lit('">x</a></p></div>')
    )
    tiles = F.array_sort(F.collect_list(F.struct("seq", tile.alias("tile"))))
    body = F.array_join(F.transform(tiles, lambda t: t["tile"]), "")
    html = F.concat(F.lit('<body><a href="/cart">cart</a>'), "body", F.lit("</body>"))
    return (
        texts.select("seq")
        .groupBy(F.floor(F.col("seq") / TILES).alias("page_id"))
        .agg(body.alias("body"))
        .select("page_id", html.alias("html"))
    )
