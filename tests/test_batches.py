"""Message identity, and tables of which readers see whole batches only."""

import pytest
from pyspark.sql import functions as F
from test_review import _message, _topic

from shelfmark.plans import inputs, jobs
from shelfmark.schema import BOOK, BOOK_AUTHOR, DETAIL, THREE_TABLES
from shelfmark.sinks.tables import BatchTables, CatalogTables
from shelfmark.streaming.ingest import LEDGER, REJECTED, TableSink, message_id, parsed

MODEL = (LEDGER, *THREE_TABLES, REJECTED)


@pytest.fixture(params=[CatalogTables, BatchTables])
def tables(request, spark, tmp_path):
    made = request.param(str(tmp_path / "t"), f"t{abs(hash(str(tmp_path))) % 10**9}_", 4)
    made.create(spark, MODEL)
    return made


def skus(spark, tables, table=BOOK):
    return sorted(r.sku for r in tables.read(spark, table).collect())


def refused(spark, tables):
    return sorted((r.src_offset, r.reasons) for r in tables.read(spark, REJECTED).collect())


def changed(frame, sku, title):
    return frame.withColumn("value", F.when(F.col("offset") >= 0, _message(sku, title)))


def test_book_is_stored_once_when_the_topic_is_made_anew(spark, tables):
    """The same place holds another message of the same sku: stored once, refused once."""
    sink = TableSink(tables)
    sink(parsed(_topic(spark, [(0, 0, "s1")])), 0)
    anew = changed(_topic(spark, [(0, 0, "s1")]), "s1", "other").union(_topic(spark, [(0, 1, "s2")]))
    sink(parsed(anew), 1)
    for table in THREE_TABLES:
        assert skus(spark, tables, table) == ["s1", "s2"]
    assert refused(spark, tables) == [(0, "duplicate_sku")]
    # A new sink that reads both topics from the start adds nothing.
    again = TableSink(tables)
    again(parsed(_topic(spark, [(0, 0, "s1")])), 0)
    again(parsed(anew), 1)
    for table in THREE_TABLES:
        assert skus(spark, tables, table) == ["s1", "s2"]
    assert refused(spark, tables) == [(0, "duplicate_sku")]


def test_the_very_message_again_adds_nothing(spark, tables):
    sink = TableSink(tables)
    sink(parsed(_topic(spark, [(0, 0, "s1")])), 0)
    sink(parsed(_topic(spark, [(0, 0, "s1"), (0, 1, "s2"), (0, 1, "s2")])), 1)
    for table in THREE_TABLES:
        assert skus(spark, tables, table) == ["s1", "s2"]
    assert refused(spark, tables) == []


def test_refused_messages_of_two_topics_are_both_kept(spark, tables):
    TableSink(tables)(parsed(_topic(spark, [(0, 0, "s1"), (0, 1, "s1")])), 0)
    TableSink(tables)(parsed(_topic(spark, [(0, 0, "s3"), (0, 1, "s3")])), 0)
    assert skus(spark, tables) == ["s1", "s3"]
    assert refused(spark, tables) == [(1, "duplicate_sku")] * 2


def test_topic_and_time_tell_messages_apart(spark):
    frame = _topic(spark, [(0, 0, "s1")]).withColumn("topic", F.lit("a"))
    frame = frame.withColumn("timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    others = [
        frame,
        frame.withColumn("topic", F.lit("b")),
        frame.withColumn("timestamp", F.lit("2024-01-01 00:00:01").cast("timestamp")),
        frame.withColumn("offset", F.lit(1).cast("long")),
        changed(frame, "s1", "x"),
        frame.withColumn("value", F.lit(None).cast("binary")),
    ]
    ids = [f.select(message_id(f)).first()[0] for f in others]
    assert len(set(ids)) == len(ids)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        moved = frame.withColumn("timestamp", F.lit("2024-01-01 09:00:00").cast("timestamp"))
        assert moved.select(message_id(moved)).first()[0] == ids[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_readers_see_whole_batches_only(spark, tmp_path):
    tables = BatchTables(str(tmp_path / "w"), "whole_", 4)
    tables.create(spark, MODEL)
    sink, put = TableSink(tables), tables.put
    sink(parsed(_topic(spark, [(0, 0, "s1")])), 0)

    def dies(rows, table, batch):
        if table is DETAIL:
            raise OSError("lost")
        put(rows, table, batch)

    second = parsed(_topic(spark, [(0, 1, "s2"), (0, 2, "s1")]))
    tables.put = dies
    with pytest.raises(OSError):
        sink(second, 1)
    tables.put = put
    torn = spark.table(tables.stored(BOOK)).where("sku = 's2'")
    assert torn.count() == 1
    for table in (LEDGER, *THREE_TABLES):
        assert skus(spark, tables, table) == ["s1"]
    assert spark.sql("SELECT count(*) FROM whole_book JOIN whole_detail USING (sku)").first()[0] == 1
    sink(second, 1)
    for table in (LEDGER, *THREE_TABLES):
        assert skus(spark, tables, table) == ["s1", "s2"]
    assert refused(spark, tables) == [(2, "duplicate_sku")]


def test_a_batch_that_counts_is_left_alone(spark, tmp_path, monkeypatch):
    tables = BatchTables(str(tmp_path / "c"), "counts_", 4)
    tables.create(spark, MODEL)
    monkeypatch.setattr(tables, "batch_name", lambda spark, n: f"stream-{n}")
    batch = parsed(_topic(spark, [(0, 0, "s1"), (0, 1, "s1")]))
    TableSink(tables)(batch, 0)
    files = spark.table(tables.stored(BOOK)).inputFiles()
    TableSink(tables)(batch, 0)
    assert spark.table(tables.stored(BOOK)).inputFiles() == files
    assert skus(spark, tables) == ["s1"] and len(refused(spark, tables)) == 1
    # An earlier try left other rows in the partition: they are replaced, also by none.
    book = tables.read(spark, BOOK)
    other = spark.createDataFrame(book.collect(), book.schema)
    tables.put(other, BOOK, "stream-1")
    tables.put(other.where("false"), BOOK, "stream-1")
    tables.commit(spark, "stream-1")
    assert skus(spark, tables) == ["s1"]


def test_batches_are_compacted_together(spark, tmp_path):
    tables = BatchTables(str(tmp_path / "k"), "packed_", 2)
    tables.create(spark, MODEL)
    sink = TableSink(tables, compact_every=3)
    for n in range(8):
        sink(parsed(_topic(spark, [(0, 2 * n, f"s{n}"), (0, 2 * n + 1, "s0")])), n)
    want = sorted(f"s{n}" for n in range(8))
    for table in (LEDGER, *THREE_TABLES):
        assert skus(spark, tables, table) == want
    assert len(refused(spark, tables)) == 8
    live = {r.batch for r in spark.table(tables.commits).collect()}
    assert len(live) == 3 and sum(b.startswith("whole-") for b in live) == 1
    # What the last compaction replaced is still there for readers; what is older is gone.
    there = {r[0].removeprefix("batch=") for r in spark.sql(f"SHOW PARTITIONS {tables.stored(BOOK)}").collect()}
    assert live <= there and len(there) <= len(live) + 4
    kept = {p.name for p in (tmp_path / "k" / "book").iterdir() if p.is_dir()}
    assert kept == {f"batch={b}" for b in there}


def test_a_catalogue_that_was_lost_finds_the_batches(spark, sf, tmp_path):
    rows = inputs.messages(spark, sf).where("offset < 50")
    tables = BatchTables(str(tmp_path / "l"), "lost_", 2)
    jobs.load_three(rows, tables)
    before = skus(spark, tables)
    for table in MODEL:
        spark.sql(f"DROP VIEW {tables.name(table)}")
        spark.sql(f"DROP TABLE {tables.stored(table)}")
    spark.sql(f"DROP TABLE {tables.commits}")
    jobs.load_three(rows, tables)
    assert skus(spark, tables) == before and before


def test_the_view_keeps_buckets(spark, tmp_path):
    """Only the names of batches are moved: children meet parents bucket by bucket."""
    tables = BatchTables(str(tmp_path / "v"), "view_", 8)
    tables.create(spark, MODEL)
    TableSink(tables)(parsed(_topic(spark, [(0, n, f"s{n}") for n in range(6)])), 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        joined = tables.read(spark, BOOK).join(tables.read(spark, BOOK_AUTHOR), "sku")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        one = joined.where("sku = 's3'")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [sku" in plan and "LeftSemi" in plan
    assert "hashpartitioning" not in plan
    assert "SelectedBucketsCount: 1 out of 8" in one
