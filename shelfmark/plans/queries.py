"""The registered queries: one per operator, over whole tables.

Names starting with ``q_`` are pure DataFrame plans, ``j_`` run a job that
writes and read the result back, ``s_`` run a stream. ``oracles.SQL`` holds the
SQL each is checked against.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.html import Page
from shelfmark.functions.text import lit, or_missing, strip
from shelfmark.operators import clean, integrity, links, messages, outbox, project, star
from shelfmark.operators.coerce import coerce, parse_typed
from shelfmark.operators.delivered import DeliveredMarks
from shelfmark.operators.fields import extract_fields, match_pages
from shelfmark.operators.history import VisitedHistory
from shelfmark.plans import inputs, jobs
from shelfmark.schema import (
    AUTHOR,
    BOOK,
    BOOK_AUTHOR,
    BOOKS,
    BRIDGE,
    CATEGORY,
    FIVE_TABLES,
    FLAT,
    RAW_FIELDS,
    RAW_SCHEMA,
    SERIAL_BRIDGE,
    SERIAL_TABLES,
    SERIES,
    THREE_TABLES,
    WAREHOUSE_NAMES,
    Table,
    message_names,
)
from shelfmark.session import scratch_dir
from shelfmark.sinks.files import land, read_csv, write_csv, write_json
from shelfmark.sinks.tables import BatchTables, CatalogTables, DividedTables
from shelfmark.sinks.topic import write_topic_files
from shelfmark.sources.documents import read_documents, read_inferred
from shelfmark.sources.pages import read_pages
from shelfmark.sources.segments import SegmentedTopic, TopicCursor
from shelfmark.sources.topic import peek, read_topic_files, stream_topic_files
from shelfmark.streaming.ingest import LEDGER, REJECTED, TableSink, drain, parsed, typed

Query = Callable[[SparkSession, str], DataFrame]

LISTING = "https://shop.example.com/books/list?order=popular&p="
SHOP = "https://shop.example.com"
DOMAINS = ["example.net", "spam-farm.example.org"]
LINK = '<a href="([^"]*)"'
NAV_LINK = '<li><a href="[^"]*">([^<]*)</a>'
LANG = '<html lang="([^"]*)"'
DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def _reasons(df: DataFrame) -> DataFrame:
    return df.withColumn("reasons", F.array_join("reasons", "|"))


# --- Sources and links -------------------------------------------------------


def q_docs_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(spark, f"{sf_dir}/documents.parquet", schema=DOCUMENTS)


def q_docs_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored JSON documents whose fields are absent, a number or a text; the schema is inferred."""
    path = scratch_dir(spark, "drift")
    rows = inputs.table(spark, sf_dir, "documents")
    fields = """doc_id, text, if(doc_id % 7 = 0, NULL, lang) AS lang,
        if(doc_id % 3 = 0, true, NULL) AS flag"""
    written = f"""if(doc_id % 5 = 0,
        to_json(struct({fields}, concat('n', n_chars) AS n_chars)),
        to_json(struct({fields}, n_chars))) AS value"""
    rows.selectExpr(written).write.text(path)
    return read_inferred(spark, path)


def q_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_pages(spark, f"{sf_dir}/pages.parquet").select("url")
    return links.frontier(pages.unionByName(links.listing_urls(spark, LISTING)))


def q_frontier_unvisited(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_pages(spark, f"{sf_dir}/pages.parquet")
    base = F.regexp_extract("url", "^(https?://[^/]+)", 1)
    found = links.pattern_links(pages, base, LINK)
    visited = pages.select(F.concat(base, F.lit("/the")).alias("url"))
    return links.frontier(found, visited)


def q_frontier_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frontier after three crawls, by the filter of the history; some hits are chance."""
    pages = read_pages(spark, f"{sf_dir}/pages.parquet")
    base = F.regexp_extract("url", "^(https?://[^/]+)", 1)
    history = VisitedHistory(scratch_dir(spark, "history"), parts=8, slots=1 << 10, spread=2)
    for crawl in range(2):
        history.add(pages.where(F.col("page_id") % 3 == crawl).select("url"))
    history.add(pages.select(F.concat(base, F.lit("/the")).alias("url")))
    found = links.pattern_links(pages, base, LINK).select("url").union(pages.select("url"))
    return history.frontier(found)


def q_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_pages(spark, f"{sf_dir}/pages.parquet")
    base = F.regexp_extract("url", "^(https?://[^/]+)", 1)
    return links.pattern_links(pages, base, LINK).select("page_id", "pos", "url")


def q_tile_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    listings = inputs.listing_pages(inputs.raw_texts(spark, sf_dir))
    return links.tile_links(listings, SHOP)


def q_domain_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_pages(spark, f"{sf_dir}/pages.parquet").select("page_id", "url")
    return pages.where(links.in_domains(F.col("url"), DOMAINS))


# --- Fields ------------------------------------------------------------------


def q_page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By pattern, in the JVM: for markup that is told apart by its own tag."""
    pages = read_pages(spark, f"{sf_dir}/pages.parquet")
    one = lambda pattern: f"regexp_extract(html, {lit(pattern)}, 1)"
    every = lambda c, pattern: f"regexp_extract_all({c}, {lit(pattern)}, 1)"
    return pages.selectExpr(
        "page_id",
        f"{or_missing(strip(one('<h1>([^<]*)</h1>')))} AS title",
        f"{or_missing(strip(one(LANG)))} AS lang",
        f"{every('html', NAV_LINK)} AS nav",
        f"concat('>', {one('(?s)<article>(.*)</article>')}, '<') AS article",
    ).selectExpr(
        "page_id",
        "title",
        "lang",
        f"{or_missing(strip('try_element_at(nav, 2)'))} AS second_nav",
        f"""{or_missing(strip("array_join(nav, ', ')"))} AS nav_texts""",
        f"""{strip(f"array_join({every('article', '>([^<]+)<')}, ' ')")} AS article_text""",
    )


def _tag_texts(page: Page, tag: str, inside: str = "") -> list[str]:
    boxes = page.tagged(inside) if inside else [0]
    return [t for b in boxes for i in page.tagged(tag, b) for t in page.own[i]]


def _all_texts(page: Page, tag: str) -> list[str]:
    return [t for i in page.tagged(tag) for t in page.texts(i)]


def q_page_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fields by element, from one parse per page, entities decoded."""
    pages = read_pages(spark, f"{sf_dir}/pages.parquet").select("page_id", "html")
    rules = {
        "h1": partial(_tag_texts, tag="h1"),
        "nav": partial(_tag_texts, tag="a", inside="nav"),
        "article": partial(_all_texts, tag="article"),
    }
    return match_pages(pages, rules, ("<h1", "<nav", "<article")).selectExpr(
        "page_id",
        f"{clean.text('try_element_at(h1, 1)')} AS title",
        f"{clean.text('try_element_at(nav, 2)')} AS second_nav",
        f"""{strip("array_join(nav, ', ')")} AS nav_texts""",
        f"""{strip("array_join(article, ' ')")} AS article_text""",
    )


def q_product_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.product_pages(inputs.raw_texts(spark, sf_dir))
    return _reasons(extract_fields(pages.drop("url")))


# --- Clean-up ----------------------------------------------------------------


def _records(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return inputs.records(spark, sf_dir).select("seq", *columns)


def q_clean_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir, "units_sold")


def q_clean_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir, "sale_price", "list_price")


def q_clean_audience(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir, "audience")


def q_clean_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reasons(_records(spark, sf_dir, "width_cm", "length_cm", "reasons")).withColumn(
        "reasons", F.regexp_extract("reasons", "unreadable_size", 0)
    )


def q_clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir, "page_count")


def q_clean_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir, "weight_g").withColumn(
        "grams", F.replace("weight_g", F.lit("."), F.lit(""))
    )


def q_clean_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(
        spark, sf_dir, "sku", "isbn", "series", "category", "binding", "title", "authors",
        "description",
    )


# --- Messages ----------------------------------------------------------------


def q_publish_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published and parsed back: the JSON text itself differs by engine."""
    parsed = messages.parse_messages(inputs.messages(spark, sf_dir))
    return parsed.select("offset", *RAW_FIELDS)


def q_publish_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole long texts through a message and back, the id removed."""
    documents = read_documents(spark, f"{sf_dir}/documents.parquet", schema=DOCUMENTS)
    body = T.StructType([f for f in DOCUMENTS.fields if f.name != "doc_id"])
    sent = messages.publish_frame(documents, drop=("doc_id",))
    return messages.parse_messages(sent, body).select(*body.fieldNames())


def q_publish_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = coerce(inputs.records(spark, sf_dir), "v4").drop("reasons")
    return project.renamed(rows).select("seq", *WAREHOUSE_NAMES.values())


def q_array_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    unsent = outbox.pending(inputs.documents(spark, sf_dir))
    numbered = integrity.number_rows(unsent, ["doc_id"], "n")
    arrays = messages.array_frame(numbered, "n", outbox.ROUND_SIZE, ("doc_id", "sent"))
    return messages.explode_arrays(arrays, RAW_SCHEMA)


def q_parse_all_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events").select(
        "event_id", F.col("props").cast("binary").alias("value")
    )
    schema = T.StructType([T.StructField("k", T.StringType())])
    parsed = messages.parse_messages(events, schema)
    return parsed.select("event_id", "k", F.col("k").try_cast("int").alias("k_int"))


def q_parse_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message of the topic, some made unreadable, told apart by reason."""
    rows = inputs.messages(spark, sf_dir)
    text = F.col("value").cast("string")
    n = F.col("offset")
    broken = (
        F.when(n % 31 == 1, F.lit("not json"))
        .when(n % 31 == 2, F.lit(""))
        .when(n % 31 == 3, F.lit(None))
        .when(n % 31 == 4, F.concat(F.lit("["), text, F.lit("]")))
        .when(n % 31 == 5, F.substring_index(text, "}", 1))
        .when(n % 31 == 6, F.lit('{"other": 1}'))
        .otherwise(text)
    )
    parsed = messages.parse_messages(rows.withColumn("value", broken.cast("binary")))
    return _reasons(parsed.select("offset", "sku", "title", "reasons"))


def q_topic_peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = peek(inputs.messages(spark, sf_dir))
    return messages.parse_messages(first).select("partition", "offset", "sku", "title")


# --- Coercion ----------------------------------------------------------------

_TYPED = (
    "units_sold", "sale_price", "list_price", "length_cm", "width_cm", "page_count", "weight_g",
)


def _coerced(spark: SparkSession, sf_dir: str, policy: str) -> DataFrame:
    return _reasons(
        coerce(inputs.records(spark, sf_dir).drop("reasons"), policy).select(
            "seq", *_TYPED, "reasons"
        )
    )


def q_coerce_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed parse of text numbers, and of the same numbers sent as numbers."""
    rows = inputs.messages(spark, sf_dir)
    as_text = parse_typed(rows.select("offset", "value"))
    numbers = coerce(inputs.records(spark, sf_dir), "v1").drop("reasons")
    sent = messages.publish_frame(
        numbers.withColumn("weight_g", F.col("weight_g").cast("int")), keep=("seq",)
    )
    as_number = parse_typed(sent.select("seq", "value"))
    return as_text.select(
        F.lit("text").alias("sent_as"), F.col("offset").alias("seq"), *_TYPED
    ).unionByName(as_number.select(F.lit("number").alias("sent_as"), "seq", *_TYPED))


def q_coerce_v4_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = coerce(inputs.records(spark, sf_dir), "v4", on_insert=True)
    return rows.select("seq", "page_count", "weight_g", "length_cm", "width_cm")


# --- Target tables -----------------------------------------------------------


def _typed_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce(inputs.records(spark, sf_dir).drop("reasons"), "v1")


def q_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message to struct to typed record to the book columns."""
    return project.book(typed(inputs.messages(spark, sf_dir)))


def q_book_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = project.book_author(_typed_v1(spark, sf_dir))
    return integrity.insert_if_absent(rows, None, BOOK_AUTHOR.key)


def q_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.detail(_typed_v1(spark, sf_dir))


def q_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.flat(_typed_v1(spark, sf_dir))


def q_pk_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.records(spark, sf_dir).drop("reasons")
    return integrity.first_wins(rows, ["sku"], ["seq"])


def q_pk_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A two-column key with many repeats: the smallest line by value wins."""
    rows = inputs.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return integrity.first_wins(
        rows, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"]
    )


def _dimension(spark: SparkSession, sf_dir: str, column: str, loaded: str) -> DataFrame:
    """New members, where names that start with ``loaded`` are in the table already."""
    rows = inputs.records(spark, sf_dir)
    target = integrity.dimension(rows, column).where(F.startswith("name", F.lit(loaded)))
    return integrity.dimension(rows, column, target)


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.book_fact(star.checked_books(inputs.records(spark, sf_dir)), ["seq"])


def q_book_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.star(_accepted(spark, sf_dir))["books"]


def q_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.bridge(_accepted(spark, sf_dir))


def q_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.records(spark, sf_dir).select("seq", "sku", "title")
    return integrity.number_rows(rows, ["seq"], "id", 1000)


def q_number_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids by an order that is null for some rows and equal for others: each row has one."""
    rows = inputs.records(spark, sf_dir).selectExpr(
        "sku", "CASE WHEN seq % 7 <> 0 THEN seq div 3 END AS place"
    )
    return integrity.number_rows(rows, ["place"], "id").selectExpr(
        "place", "id - min(id) OVER (PARTITION BY place) AS nth", "min(id) OVER (PARTITION BY place) AS first"
    )


def q_serial_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = star.checked_books(inputs.records(spark, sf_dir))
    return star.serial_books(checked, ["seq"]).select(*SERIAL_BRIDGE.column_names)


def q_serial_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = star.checked_books(inputs.records(spark, sf_dir))
    return star.serial_books(checked, ["seq"], 500).drop("author")


def q_fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )
    orders = inputs.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return integrity.with_parent(lines, orders, {"l_orderkey": "o_orderkey"})


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = coerce(inputs.records(spark, sf_dir), "v1")
    return integrity.row_reasons(rows, THREE_TABLES)


def q_fk_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details of all records, kept only where the book was accepted."""
    books = integrity.accept_books(_checked(spark, sf_dir), "sku", ["seq"])
    details = _typed_v1(spark, sf_dir).select("seq", "sku", "binding", "units_sold")
    return integrity.kept_children(details, books, {"sku": "sku"})


def q_fk_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = integrity.accept_books(_checked(spark, sf_dir), "sku", ["seq"])
    details = _typed_v1(spark, sf_dir).select("seq", "sku", "binding", "units_sold")
    return integrity.orphans(details, books, {"sku": "sku"})


def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = coerce(inputs.records(spark, sf_dir), "v5")
    checked = integrity.row_reasons(rows, THREE_TABLES)
    labelled = integrity.label_duplicates(checked, "sku", ["seq"])
    return _reasons(integrity.quarantined(labelled).select("seq", "sku", "reasons"))


def q_accept_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books a strict row loader takes, given those of an earlier load."""
    rows = coerce(inputs.records(spark, sf_dir), "v3")
    checked = integrity.row_reasons(rows, THREE_TABLES)
    earlier = inputs.records(spark, sf_dir).where(F.col("category") == "SMALL").select("sku")
    accepted = integrity.accept_books(checked, "sku", ["seq"], earlier)
    return accepted.select("seq", "sku", *_TYPED)


def q_cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _typed_v1(spark, sf_dir)
    deleted = project.book(rows).where(F.col("category") == "SMALL")
    details = integrity.cascade_delete(project.detail(rows), deleted, BOOK.key)
    authors = integrity.cascade_delete(project.book_author(rows), deleted, BOOK.key)
    return details.select(F.lit("detail").alias("child"), "sku", "binding").unionByName(
        authors.select(F.lit("author").alias("child"), "sku", F.col("authors").alias("binding"))
    )


# --- Outbox ------------------------------------------------------------------


def q_outbox_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outbox.pending(inputs.documents(spark, sf_dir)).select("doc_id", "sku", "sent")


def q_outbox_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outbox.bounded_run(inputs.documents(spark, sf_dir)).select("doc_id", "sku", "round")


def q_outbox_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.documents(spark, sf_dir)
    sent_now = outbox.rounds(outbox.pending(documents)).select("doc_id")
    return outbox.mark_delivered(documents, sent_now).select("doc_id", "sku", "sent")


# --- Jobs and streams --------------------------------------------------------


def j_relay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bounded runs, then one without a limit: what reached the topic."""
    topic, marks = scratch_dir(spark, "topic"), scratch_dir(spark, "delivered")
    documents = inputs.documents(spark, sf_dir)
    send = lambda rows: write_topic_files(rows, topic, F.col("doc_id"))
    mark = lambda ids: ids.write.mode("append").parquet(marks)
    jobs.relay(documents, None, send, mark)
    for bounded in (True, False):
        jobs.relay(documents, spark.read.parquet(marks), send, mark, bounded)
    arrived = messages.parse_messages(read_topic_files(spark, topic))
    delivered = spark.read.parquet(marks).withColumnRenamed("doc_id", "offset")
    return arrived.join(delivered, "offset").select("offset", "sku", "title")


def j_relay_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four bounded runs, then one without a limit, with bitmaps as marks: what reached the topic."""
    topic, marks = scratch_dir(spark, "topic"), DeliveredMarks(scratch_dir(spark, "marks"))
    documents = inputs.documents(spark, sf_dir)
    send = lambda rows: write_topic_files(rows, topic, F.col("doc_id"))
    for bounded in (True, True, True, True, False):
        jobs.relay_marked(documents, marks, send, bounded)
    arrived = messages.parse_messages(read_topic_files(spark, topic))
    left = marks.undelivered(arrived, "offset").select("offset").withColumn("_left", F.lit(1))
    marked = arrived.join(left, "offset", "left").where("_left IS NULL")
    return marked.select("offset", "sku", "title")


def _three(spark: SparkSession, tables: CatalogTables) -> DataFrame:
    """The three tables and the rejects as one tagged frame."""
    book, author, detail = (tables.read(spark, t) for t in THREE_TABLES)
    rejected = tables.read(spark, REJECTED).select(
        F.col("src_offset").cast("string").alias("sku"), F.col("reasons").alias("title")
    )
    parts = [("book", book), ("book_author", author), ("detail", detail), ("rejected", rejected)]
    tagged = [part.withColumn("tbl", F.lit(name)) for name, part in parts]
    whole = tagged[0]
    for part in tagged[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def _drop_files(spark: SparkSession, sf_dir: str, topic: str, late: bool) -> None:
    """One of two file drops; the second repeats some messages of the first."""
    rows = inputs.messages(spark, sf_dir)
    half = F.col("offset") % 2
    wanted = (half == 1) | (F.col("offset") % 11 == 0) if late else half == 0
    write_topic_files(rows.where(wanted), topic, F.col("offset"))


def s_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two file drops, a drain after each; the second one from a new sink."""
    topic = scratch_dir(spark, "topic")
    tables = CatalogTables(scratch_dir(spark, "tables"), f"ingest_{topic[-8:]}_", buckets=8)
    tables.create(spark, (LEDGER, *THREE_TABLES, REJECTED))
    checkpoint = scratch_dir(spark, "offsets")
    for late in (False, True):
        _drop_files(spark, sf_dir, topic, late)
        drain(spark, stream_topic_files(spark, topic), TableSink(tables), checkpoint)
    return _three(spark, tables)


def j_load_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load as one batch, run twice: the second run adds nothing."""
    location = scratch_dir(spark, "tables")
    tables = CatalogTables(location, f"three_{location[-8:]}_", buckets=8)
    for _ in range(2):
        jobs.load_three(inputs.messages(spark, sf_dir), tables)
    return _three(spark, tables)


def s_ingest_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch whose second write fails, taken again by the same sink, between two others."""
    location = scratch_dir(spark, "tables")
    tables = CatalogTables(location, f"again_{location[-8:]}_", buckets=8)
    tables.create(spark, (LEDGER, *THREE_TABLES, REJECTED))
    sink, failing = TableSink(tables), _FailsOnce(tables, BOOK_AUTHOR.name)
    rows = inputs.messages(spark, sf_dir)
    for part in range(3):
        batch = parsed(rows.where(F.col("offset") % 3 == part))
        if part == 1:
            sink.tables = failing
            try:
                sink(batch, part)
            except RuntimeError:
                sink.tables = tables
        sink(batch, part)
    return _three(spark, tables)


def s_ingest_torn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that stops after the second write of a batch, and goes on from a new sink.

    Rows a reader finds of the torn batch would be in the result as ``torn``: there are none.
    """
    topic, checkpoint = scratch_dir(spark, "topic"), scratch_dir(spark, "offsets")
    tables = BatchTables(scratch_dir(spark, "tables"), f"torn_{topic[-8:]}_", buckets=8)
    model = (LEDGER, *THREE_TABLES, REJECTED)
    tables.create(spark, model)
    sinks = (TableSink(tables), TableSink(_FailsOnce(tables, BOOK_AUTHOR.name)), TableSink(tables))
    rows, seen = inputs.messages(spark, sf_dir), {}
    for part, sink in enumerate(sinks):
        if part < 2:
            drop = rows.where(F.col("offset") % 2 == part)
            write_topic_files(drop, topic, F.col("offset"))
        try:
            drain(spark, stream_topic_files(spark, topic), sink, checkpoint)
        except StreamingQueryException:
            seen["after"] = {t.name: tables.read(spark, t).count() for t in model}
        else:
            seen.setdefault("before", {t.name: tables.read(spark, t).count() for t in model})
    torn = [(t.name,) for t in model if seen["after"][t.name] != seen["before"][t.name]]
    found = spark.createDataFrame(torn, "title string").withColumn("tbl", F.lit("torn"))
    return _three(spark, tables).unionByName(found, allowMissingColumns=True)


def s_ingest_recreated_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics made anew, whose offsets start again, also with the sku that was there before.

    The first two go through one sink; a second sink reads the new topic from the start.
    """
    rows = inputs.messages(spark, sf_dir)
    old, new = scratch_dir(spark, "topic"), scratch_dir(spark, "topic")
    tables = CatalogTables(scratch_dir(spark, "tables"), f"anew_{old[-8:]}_", buckets=8)
    tables.create(spark, (LEDGER, *THREE_TABLES, REJECTED))
    write_topic_files(rows.where("offset % 2 = 0"), old, F.col("offset"))
    write_topic_files(rows.where("offset % 2 = 1"), new, F.col("offset") - 3)
    sink = TableSink(tables)
    for topic, into in ((old, sink), (new, sink), (new, TableSink(tables))):
        drain(spark, stream_topic_files(spark, topic), into, scratch_dir(spark, "offsets"))
    return _three(spark, tables)


class _FailsOnce:
    """Tables of which one cannot be written."""

    def __init__(self, tables: CatalogTables, name: str):
        self.tables = tables
        self.refused = name

    def __getattr__(self, name: str):
        return getattr(self.tables, name)

    def append(self, rows: DataFrame, table: Table) -> None:
        if table.name == self.refused:
            raise RuntimeError("the write failed")
        self.tables.append(rows, table)

    def put(self, rows: DataFrame, table: Table, batch: str) -> None:
        if table.name == self.refused:
            raise RuntimeError("the write failed")
        self.tables.put(rows, table, batch)


def s_ingest_crawler_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream over messages with the crawler's own field names."""
    names = message_names("maHang")
    topic, location = scratch_dir(spark, "topic"), scratch_dir(spark, "tables")
    rows = inputs.records(spark, sf_dir).select(F.col("seq").alias("offset"), *RAW_FIELDS)
    sent = messages.publish_frame(project.renamed(rows, names), keep=("offset",))
    write_topic_files(sent, topic, F.col("offset"))
    tables = CatalogTables(location, f"names_{location[-8:]}_", buckets=8)
    tables.create(spark, (LEDGER, *THREE_TABLES, REJECTED))
    checkpoint = scratch_dir(spark, "offsets")
    drain(spark, stream_topic_files(spark, topic), TableSink(tables), checkpoint, names)
    return _three(spark, tables)


def j_two_crawls_relay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land and relay, twice into one folder: all that was landed is sent."""
    folder, topic = scratch_dir(spark, "landing"), scratch_dir(spark, "topic")
    marks = scratch_dir(spark, "delivered")
    send = lambda rows: write_topic_files(rows, topic, F.col("doc_id"))
    mark = lambda ids: ids.write.mode("append").parquet(marks)
    for again in (False, True):
        land(inputs.records(spark, sf_dir), folder)
        delivered = spark.read.parquet(marks) if again else None
        stored = read_documents(spark, f"{folder}/documents")
        jobs.relay(stored, delivered, send, mark, bounded=False)
    arrived = messages.parse_messages(read_topic_files(spark, topic))
    return arrived.select("sku", "title")


def j_parallel_crawls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three crawls land in one store at the same time: how many documents share an id."""
    folder = scratch_dir(spark, "crawls")
    rows = inputs.records(spark, sf_dir)

    def land_part(part: int) -> None:
        found = rows.where(F.col("seq") % 3 == part)
        land(found, f"{folder}/{part}", store=f"{folder}/documents")

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(land_part, range(3)))
    stored = read_documents(spark, f"{folder}/documents")
    same = stored.groupBy("doc_id").agg(F.count("*").alias("copies"))
    return stored.join(same, "doc_id").select("sku", "title", "copies")


def q_topic_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic of four partitions in bounded reads, each from where the last one ended."""
    rows = inputs.messages(spark, sf_dir)
    most = max(1, rows.count() // 10)
    topic = SegmentedTopic(scratch_dir(spark, "topic"), size=max(1, most // 3))
    cursor = TopicCursor(scratch_dir(spark, "cursor"))
    place = (F.col("offset") % 4, F.expr("offset div 4"), F.timestamp_millis("offset"))
    topic.write(rows, *place)
    found, run = [], 0
    while ranges := cursor.next_ranges(spark, topic, most):
        part = messages.parse_messages(topic.read(spark, ranges))
        found.append(part.select(F.lit(run).alias("run"), "partition", "offset", "sku"))
        cursor.commit(spark, ranges)
        run += 1
    return reduce(DataFrame.union, found)


def tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five tables made, loaded twice and read back as one tagged frame."""
    location = scratch_dir(spark, "tables")
    store = CatalogTables(location, f"five_{location[-8:]}_", buckets=8)
    for _ in range(2):
        jobs.load_five(inputs.records(spark, sf_dir), ["seq"], store)
    return _tagged(spark, store, FIVE_TABLES)


def _tagged(spark: SparkSession, store: CatalogTables, model: tuple[Table, ...]) -> DataFrame:
    whole = None
    for table in model:
        part = store.read(spark, table).withColumn("tbl", F.lit(table.name))
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    return whole


def j_load_five_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that stops before the bridge; the next one also has earlier rows of its books."""
    location = scratch_dir(spark, "tables")
    store = CatalogTables(location, f"five_{location[-8:]}_", buckets=8)
    rows = inputs.records(spark, sf_dir)
    try:
        jobs.load_five(rows.where("seq % 3 = 0"), ["seq"], _FailsOnce(store, BRIDGE.name))
    except RuntimeError:
        jobs.load_five(rows, ["seq"], store)
    return _tagged(spark, store, FIVE_TABLES)


def j_load_serial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serial form after two loads: ids go on, dimensions stay."""
    location = scratch_dir(spark, "tables")
    store = CatalogTables(location, f"serial_{location[-8:]}_", buckets=8)
    for _ in range(2):
        jobs.load_serial(inputs.records(spark, sf_dir), ["seq"], store)
    return _tagged(spark, store, SERIAL_TABLES)


def j_cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables after their books of one category were deleted."""
    location = scratch_dir(spark, "tables")
    tables = DividedTables(location, f"gone_{location[-8:]}_", buckets=8)
    rows = inputs.messages(spark, sf_dir)
    jobs.load_three(rows, tables)
    small = tables.read(spark, BOOK).where("category = 'SMALL'").select("sku")
    jobs.delete_books(tables, small)
    return _three(spark, tables)


def j_delete_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five tables, whose keys do not cascade, after books and then unused names were deleted.

    Books with a bridge row are kept, so the first try deletes none.
    """
    location = scratch_dir(spark, "tables")
    store = DividedTables(location, f"five_{location[-8:]}_", buckets=8)
    jobs.load_five(inputs.records(spark, sf_dir), ["seq"], store)
    small = store.read(spark, BOOKS).where("category = 'SMALL'").select("sku")
    kept = jobs.delete_rows(store, FIVE_TABLES, BOOKS, small)
    jobs.delete_rows(store, FIVE_TABLES, BRIDGE, kept)
    jobs.delete_rows(store, FIVE_TABLES, BOOKS, kept)
    for table in (SERIES, CATEGORY, AUTHOR):
        jobs.delete_rows(store, FIVE_TABLES, table, store.read(spark, table).select("name"))
    return _tagged(spark, store, FIVE_TABLES)


def j_load_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table after two loads: the second one goes on counting."""
    location = scratch_dir(spark, "tables")
    store = CatalogTables(location, f"flat_{location[-8:]}_", buckets=8)
    for _ in range(2):
        jobs.load_flat(_typed_v1(spark, sf_dir), ["seq"], store)
    return store.read(spark, FLAT)


def j_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    write_csv(inputs.records(spark, sf_dir), path)
    return read_csv(spark, path)


def j_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "json")
    write_json(inputs.records(spark, sf_dir), path)
    return read_documents(spark, path, "json", RAW_SCHEMA)


def j_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored documents after the sink chain, which refuses absent fields."""
    folder = scratch_dir(spark, "landing")
    land(inputs.records(spark, sf_dir), folder)
    return read_documents(spark, f"{folder}/documents").select(*RAW_FIELDS, "sent")


def j_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages to links to landed product pages to stored documents."""
    texts = inputs.raw_texts(spark, sf_dir)
    folder = scratch_dir(spark, "crawl")
    landed = inputs.product_pages(texts).withColumn("url", links.absolute(SHOP, F.col("url")))
    jobs.crawl(inputs.listing_pages(texts), landed, SHOP, folder)
    return read_documents(spark, f"{folder}/documents").select(*RAW_FIELDS)


QUERIES: dict[str, Query] = {
    "q_docs_scan": q_docs_scan,
    "q_docs_inferred": q_docs_inferred,
    "q_frontier": q_frontier,
    "q_frontier_unvisited": q_frontier_unvisited,
    "q_frontier_history": q_frontier_history,
    "q_links": q_links,
    "q_tile_links": q_tile_links,
    "q_domain_filter": q_domain_filter,
    "q_page_fields": q_page_fields,
    "q_page_tree": q_page_tree,
    "q_product_fields": q_product_fields,
    "q_clean_units": q_clean_units,
    "q_clean_price": q_clean_price,
    "q_clean_audience": q_clean_audience,
    "q_clean_size": q_clean_size,
    "q_clean_pages": q_clean_pages,
    "q_clean_weight": q_clean_weight,
    "q_clean_identity": q_clean_identity,
    "q_publish_json": q_publish_json,
    "q_publish_documents": q_publish_documents,
    "q_publish_renamed": q_publish_renamed,
    "q_array_messages": q_array_messages,
    "q_parse_all_string": q_parse_all_string,
    "q_parse_quarantine": q_parse_quarantine,
    "q_topic_peek": q_topic_peek,
    "q_topic_range": q_topic_range,
    "q_coerce_v1": partial(_coerced, policy="v1"),
    "q_coerce_v2": q_coerce_v2,
    "q_coerce_v3": partial(_coerced, policy="v3"),
    "q_coerce_v4": partial(_coerced, policy="v4"),
    "q_coerce_v4_insert": q_coerce_v4_insert,
    "q_coerce_v5": partial(_coerced, policy="v5"),
    "q_book": q_book,
    "q_book_author": q_book_author,
    "q_detail": q_detail,
    "q_flat": q_flat,
    "q_pk_first_wins": q_pk_first_wins,
    "q_pk_order_lines": q_pk_order_lines,
    "q_dim_series": partial(_dimension, column="series", loaded="Brand#1"),
    "q_dim_category": partial(_dimension, column="category", loaded="S"),
    "q_dim_author": partial(_dimension, column="authors", loaded="Brand#1"),
    "q_book_fact": q_book_fact,
    "q_bridge": q_bridge,
    "q_surrogate_key": q_surrogate_key,
    "q_number_nulls": q_number_nulls,
    "q_serial_books": q_serial_books,
    "q_serial_bridge": q_serial_bridge,
    "q_fk_orphans": q_fk_orphans,
    "q_fk_children": q_fk_children,
    "q_fk_refused": q_fk_refused,
    "q_quarantine": q_quarantine,
    "q_accept_books": q_accept_books,
    "q_cascade_delete": q_cascade_delete,
    "q_outbox_pending": q_outbox_pending,
    "q_outbox_batches": q_outbox_batches,
    "q_outbox_mark": q_outbox_mark,
    "j_relay": j_relay,
    "j_relay_bitmap": j_relay_bitmap,
    "s_ingest": s_ingest,
    "s_ingest_restart": s_ingest_restart,
    "s_ingest_torn": s_ingest_torn,
    "s_ingest_recreated_topic": s_ingest_recreated_topic,
    "s_ingest_crawler_names": s_ingest_crawler_names,
    "j_load_three": j_load_three,
    "tables": tables,
    "j_load_five_restart": j_load_five_restart,
    "j_load_serial": j_load_serial,
    "j_cascade_delete": j_cascade_delete,
    "j_delete_five": j_delete_five,
    "j_load_flat": j_load_flat,
    "j_csv": j_csv,
    "j_json": j_json,
    "j_landing": j_landing,
    "j_crawl": j_crawl,
    "j_two_crawls_relay": j_two_crawls_relay,
    "j_parallel_crawls": j_parallel_crawls,
}
