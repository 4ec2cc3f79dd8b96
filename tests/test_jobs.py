"""Jobs end to end: sinks, relay, stream, restarts, reruns."""

import csv
import glob
import json

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import outbox
from shelfmark.plans import inputs, jobs
from shelfmark.schema import (
    BOOK,
    BOOK_AUTHOR,
    CSV_COLUMNS,
    DETAIL,
    DOCUMENT_SCHEMA,
    FIVE_TABLES,
    RAW_FIELDS,
    RAW_SCHEMA,
    THREE_TABLES,
)
from shelfmark.session import scratch_dir
from shelfmark.sinks.files import append_documents, land, read_csv, write_csv, write_json
from shelfmark.sinks.tables import CatalogTables, JdbcTables
from shelfmark.sinks.topic import write_topic_files
from shelfmark.sources.documents import or_none, read_documents
from shelfmark.sources.topic import read_topic_files, stream_topic_files
from shelfmark.streaming.ingest import LEDGER, REJECTED, TableSink, drain


def records(spark, *dicts):
    rows = [{f: "x" for f in RAW_FIELDS} | d for d in dicts]
    return spark.createDataFrame([tuple(r[f] for f in RAW_FIELDS) for r in rows], RAW_SCHEMA)


# --- File sinks --------------------------------------------------------------

AWKWARD = {"title": 'He said "a, b"', "description": "line one\nline two", "binding": " bìa "}


def test_csv_text(spark, tmp_path):
    write_csv(records(spark, AWKWARD).coalesce(1), str(tmp_path / "csv"), bom=True)
    (name,) = glob.glob(str(tmp_path / "csv" / "part-*"))
    with open(name, encoding="utf-8") as file:
        text = file.read()
    assert text.startswith("\ufeff")
    header, row = csv.reader(text[1:].splitlines(keepends=True))
    assert header == [label for _, label in CSV_COLUMNS]
    got = dict(zip([name for name, _ in CSV_COLUMNS], row))
    assert got["title"] == AWKWARD["title"] and got["description"] == AWKWARD["description"]
    assert got["binding"] == "bìa" and got["sku"] == "x"
    assert '"x"' not in text


def test_csv_reads_back(spark, tmp_path):
    write_csv(records(spark, AWKWARD), str(tmp_path / "csv"))
    row = read_csv(spark, str(tmp_path / "csv")).first()
    assert (row.title, row.description) == (AWKWARD["title"], AWKWARD["description"])


def test_json_lines(spark, tmp_path):
    write_json(records(spark, AWKWARD | {"isbn": None}).coalesce(1), str(tmp_path / "json"))
    (name,) = glob.glob(str(tmp_path / "json" / "part-*.json"))
    with open(name, encoding="utf-8") as file:
        (line,) = file.read().splitlines()
    assert "bìa" in line and "\\u" not in line
    got = json.loads(line)
    assert set(got) == set(RAW_FIELDS) and got["isbn"] is None


def test_landing_appends_and_refuses_absent_fields(spark, tmp_path):
    folder = str(tmp_path / "land")
    land(records(spark, {"sku": "1"}, {"sku": "2", "isbn": None}), folder)
    first = read_documents(spark, f"{folder}/documents")
    assert [r.sku for r in first.collect()] == ["1"]
    assert spark.read.json(f"{folder}/rejected").first().reasons == ["absent_isbn"]
    last = first.agg(F.max("doc_id")).first()[0]
    append_documents(records(spark, {"sku": "1"}, {"sku": "3"}), f"{folder}/documents", last)
    both = read_documents(spark, f"{folder}/documents")
    assert sorted(r.sku for r in both.collect()) == ["1", "1", "3"]
    assert both.select("doc_id").distinct().count() == 3


def test_documents_inferred_named_and_empty(spark, tmp_path):
    path = str(tmp_path / "docs")
    records(spark, {"sku": "1"}).withColumnsRenamed({"sku": "code"}).write.json(path)
    inferred = read_documents(spark, path, "json", None, names={"code": "sku"})
    assert inferred.first().sku == "1"
    assert or_none(inferred) is not None
    assert or_none(spark.createDataFrame([], DOCUMENT_SCHEMA)) is None


# --- Outbox ------------------------------------------------------------------


def documents(spark, count):
    flag = F.expr("CASE id % 3 WHEN 0 THEN true WHEN 1 THEN false END")
    texts = [F.lit("x").alias(f) for f in RAW_FIELDS]
    return spark.range(count).select(F.col("id").alias("doc_id"), *texts, flag.alias("sent"))


def test_null_flag_counts_as_unsent(spark):
    rows = outbox.pending(documents(spark, 9)).collect()
    assert sorted(r.doc_id for r in rows) == [1, 2, 4, 5, 7, 8]


def test_rounds(spark):
    rows = outbox.bounded_run(documents(spark, 600)).collect()
    assert len(rows) == 250
    assert {r["round"]: 0 for r in rows} == {n: 0 for n in range(5)}
    assert max(r.doc_id for r in rows) < 376


def test_relay_is_at_least_once(spark, tmp_path):
    """A failure between send and mark sends the batch again; then all is marked."""
    topic, marks = str(tmp_path / "topic"), str(tmp_path / "marks")
    docs = documents(spark, 300)
    send = lambda rows: write_topic_files(rows, topic, F.col("doc_id"))
    mark = lambda ids: ids.write.mode("append").parquet(marks)

    def crash(_):
        raise OSError("lost")

    with pytest.raises(OSError):
        jobs.relay(docs, None, send, crash, bounded=False)
    jobs.relay(docs, None, send, mark, bounded=False)
    assert read_topic_files(spark, topic).count() == 400
    assert spark.read.parquet(marks).count() == 200
    jobs.relay(docs, spark.read.parquet(marks), send, mark)
    assert read_topic_files(spark, topic).count() == 400
    flags = outbox.mark_delivered(docs, spark.read.parquet(marks))
    assert flags.where("sent").count() == 300


# --- Tables and stream -------------------------------------------------------


def message(offset, sku, **fields):
    body = {"sku": sku, "title": "t", "authors": "A", "sale_price": "1000"} | fields
    return (None, bytearray(json.dumps(body), "utf-8"), 0, offset)


def topic_frame(spark, rows):
    return spark.createDataFrame(rows, "key binary, value binary, partition int, offset long")


def store(spark, tmp_path, prefix):
    tables = CatalogTables(str(tmp_path / prefix), f"{prefix}_", buckets=4)
    tables.create(spark, (LEDGER, *THREE_TABLES, REJECTED))
    return tables


def contents(spark, tables):
    return {
        t.name: sorted(map(str, tables.read(spark, t).collect())) for t in (*THREE_TABLES, REJECTED)
    }


BATCH = [
    message(0, "s1"),
    message(1, "s1", authors="B"),
    message(2, "s2", authors=None),
    message(3, None),
    (None, bytearray(b"junk"), 0, 4),
    message(5, "s3", title="t" * 256),
]


def test_one_batch(spark, tmp_path):
    tables = store(spark, tmp_path, "one")
    jobs.load_three(topic_frame(spark, BATCH), tables)
    assert {r.sku for r in tables.read(spark, BOOK).collect()} == {"s1", "s2"}
    assert [tuple(r) for r in tables.read(spark, BOOK_AUTHOR).collect()] == [("s1", "A")]
    assert {r.sku for r in tables.read(spark, DETAIL).collect()} == {"s1", "s2"}
    refused = {r.src_offset: r for r in tables.read(spark, REJECTED).collect()}
    assert {k: r.reasons for k, r in refused.items()} == {
        1: "duplicate_sku",
        3: "null_sku",
        4: "broken_json|null_sku",
        5: "too_long_title",
    }
    assert refused[4].message == "junk"


def test_rerun_and_half_finished_run(spark, tmp_path):
    """A run that dies before the children is completed by the next one."""
    whole = store(spark, tmp_path, "whole")
    jobs.load_three(topic_frame(spark, BATCH), whole)
    want = contents(spark, whole)
    half = store(spark, tmp_path, "half")
    append, written = half.append, []

    def dies(rows, table):
        if table is BOOK_AUTHOR:
            raise OSError("lost")
        written.append(table.name)
        append(rows, table)

    half.append = dies
    with pytest.raises(OSError):
        jobs.load_three(topic_frame(spark, BATCH), half)
    assert written == ["book_origin", "book"]
    half.append = append
    for _ in range(2):
        jobs.load_three(topic_frame(spark, BATCH), half)
        assert contents(spark, half) == want


def test_stream_equals_batch_and_survives_restart(spark, tmp_path):
    rows = [message(i, f"s{i % 7}", authors=f"A{i}") for i in range(20)]
    batch = store(spark, tmp_path, "batch")
    jobs.load_three(topic_frame(spark, rows), batch)
    want = contents(spark, batch)
    tables, folder = store(spark, tmp_path, "live"), str(tmp_path / "topic")
    checkpoint = str(tmp_path / "offsets")
    for part in (rows[:10], rows[10:]):
        # One file per drop: batches come in the order of offsets, as from a topic.
        write_topic_files(topic_frame(spark, part).coalesce(1), folder, F.col("offset"))
        drain(spark, stream_topic_files(spark, folder, 1), TableSink(tables), checkpoint)
    assert contents(spark, tables) == want
    # The checkpoint is lost: the whole topic is read again, nothing is added.
    drain(spark, stream_topic_files(spark, folder), TableSink(tables), str(tmp_path / "new"))
    assert contents(spark, tables) == want


def test_later_copy_of_a_loaded_book_changes_nothing(spark, tmp_path):
    tables = store(spark, tmp_path, "later")
    sink = TableSink(tables)
    from shelfmark.streaming.ingest import parsed

    sink(parsed(topic_frame(spark, [message(0, "s1")])), 0)
    sink(parsed(topic_frame(spark, [message(9, "s1", authors="B"), message(10, "s2")])), 1)
    assert {r.sku for r in tables.read(spark, BOOK).collect()} == {"s1", "s2"}
    assert {r.authors for r in tables.read(spark, BOOK_AUTHOR).collect()} == {"A"}
    assert [r.reasons for r in tables.read(spark, REJECTED).collect()] == ["duplicate_sku"]


def test_five_tables_half_finished_run(spark, sf, tmp_path):
    rows = inputs.records(spark, sf)

    def state(tables):
        return {t.name: sorted(map(str, tables.read(spark, t).collect())) for t in FIVE_TABLES}

    whole = CatalogTables(str(tmp_path / "w"), "five_w_", 4)
    jobs.load_five(rows, ["seq"], whole)
    half = CatalogTables(str(tmp_path / "h"), "five_h_", 4)
    append = half.append

    def dies(part, table):
        if table.name == "book_author_bridge":
            raise OSError("lost")
        append(part, table)

    half.append = dies
    with pytest.raises(OSError):
        jobs.load_five(rows, ["seq"], half)
    half.append = append
    jobs.load_five(rows, ["seq"], half)
    assert state(half) == state(whole)


def test_crawl_skips_visited_pages(spark, sf, tmp_path):
    texts = inputs.raw_texts(spark, sf).where("seq < 48")
    landed = inputs.product_pages(texts).withColumn("url", F.concat(F.lit("http://h"), "url"))
    visited = landed.where("seq < 24").select("url")
    jobs.crawl(inputs.listing_pages(texts), landed, "http://h", str(tmp_path), visited=visited)
    kept = read_documents(spark, f"{tmp_path}/documents")
    refused = spark.read.json(f"{tmp_path}/rejected").count()
    assert kept.count() + refused == 48 - 24 - 2


def test_ddl(spark, tmp_path):
    catalog = CatalogTables("/data", "p_", 64)
    assert catalog.ddl(BOOK_AUTHOR) == (
        "CREATE TABLE IF NOT EXISTS p_book_author (sku string, authors string) USING parquet"
        " CLUSTERED BY (sku) INTO 64 BUCKETS LOCATION '/data/book_author'"
    )
    jdbc = JdbcTables("jdbc:postgresql://h/db", {"user": "u"})
    assert jdbc.ddl(BOOK_AUTHOR) == (
        "CREATE TABLE IF NOT EXISTS book_author (sku VARCHAR(255), authors VARCHAR(255), "
        "PRIMARY KEY (sku, authors), FOREIGN KEY (sku) REFERENCES book(sku) ON DELETE CASCADE)"
    )


def test_scratch_is_under_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(root)
