"""The four jobs: crawl output, outbox relay, message ingest, batch loads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators import outbox, star
from shelfmark.operators.delivered import DeliveredMarks
from shelfmark.operators.fields import SiteProfile, extract_fields
from shelfmark.operators.integrity import kept_children, not_in, number_rows
from shelfmark.operators.links import frontier, normal_url, tile_links
from shelfmark.operators.messages import publish_frame
from shelfmark.schema import (
    BOOK,
    BOOKS_PENDING,
    BRIDGE,
    FIVE_TABLES,
    FLAT,
    RAW_FIELDS,
    SERIAL_BOOKS,
    SERIAL_PENDING,
    SERIAL_TABLES,
    THREE_TABLES,
    Table,
)
from shelfmark.session import scratch_dir
from shelfmark.sinks.files import land
from shelfmark.sinks.tables import CatalogTables, DividedTables
from shelfmark.sources.documents import or_none
from shelfmark.streaming.ingest import LEDGER, REJECTED, TableSink, parsed


def crawl(
    listings: DataFrame,
    landed: DataFrame,
    base: str | Column,
    folder: str,
    site: SiteProfile = SiteProfile(),
    visited: DataFrame | None = None,
) -> None:
    """Listing pages to the three sinks.

    ``landed`` holds the fetched product pages (``url``, ``html``). Only pages
    that a listing links to, and that were not visited, are extracted.
    """
    wanted = frontier(tile_links(listings, base), visited)
    pages = landed.withColumn("url", normal_url(landed["url"]))
    pages = kept_children(pages, wanted, {"url": "url"})
    land(extract_fields(pages.select("url", "html"), site).select(*RAW_FIELDS), folder)


def relay(
    documents: DataFrame,
    delivered: DataFrame | None,
    send: Callable[[DataFrame], None],
    mark: Callable[[DataFrame], None],
    bounded: bool = True,
) -> None:
    """Unsent documents to the topic, then their ids to the delivered table.

    The batch is written to the shared folder first, so what is marked is
    exactly what was sent. A failure between the two sends the batch again: at
    least once.
    """
    if bounded:
        unsent = outbox.bounded_run(documents, delivered).drop("round")
    else:
        unsent = outbox.pending(documents, delivered)
    _send(unsent, send, mark)


def relay_marked(
    documents: DataFrame,
    marks: DeliveredMarks,
    send: Callable[[DataFrame], None],
    bounded: bool = True,
) -> None:
    """As ``relay``, with one bit for a delivered document instead of a row."""
    if bounded:
        flags = marks.undelivered(documents.select("doc_id", "sent"))
        ids = outbox.rounds(outbox.pending(flags)).select("doc_id")
        unsent = documents.join(ids, "doc_id", "left_semi")
    else:
        unsent = marks.undelivered(outbox.pending(documents))
    _send(unsent, send, marks.mark)
    marks.compact(documents.sparkSession)


def _send(
    unsent: DataFrame,
    send: Callable[[DataFrame], None],
    mark: Callable[[DataFrame], None],
) -> None:
    """Out first, then marked, from one written batch."""
    spark = unsent.sparkSession
    path = scratch_dir(spark, "relay")
    unsent.write.parquet(path)
    batch = spark.read.schema(unsent.schema).parquet(path)
    if batch.isEmpty():
        return
    send(publish_frame(batch, keep=("doc_id",)))
    mark(batch.select("doc_id"))


def load_three(messages: DataFrame, tables: CatalogTables, policy: str = "v1") -> None:
    """Messages to the three tables in one batch, with the stream's own sink."""
    tables.create(messages.sparkSession, (LEDGER, *THREE_TABLES, REJECTED))
    TableSink(tables, policy)(parsed(messages), 0)


def load_flat(records: DataFrame, order: list[str], tables: CatalogTables) -> None:
    """Typed records to the flat table; ids go on after the last one.

    There is no other key, so a second run appends the records again. Without a
    record nothing is made or written (S5).
    """
    if or_none(records) is None:
        return
    spark = records.sparkSession
    tables.create(spark, (FLAT,))
    last = tables.read(spark, FLAT).agg(F.max("id")).first()[0] or 0
    tables.append(number_rows(records, order, "id", last), FLAT)


def load_five(records: DataFrame, order: list[str], tables: CatalogTables) -> None:
    """Records to the five tables, parents first; a second run adds nothing.

    What a run will add is decided once and written whole before any target. A
    run that fails on the way is completed from there by the next one, before
    that looks at its own records.
    """
    spark: SparkSession = records.sparkSession
    tables.create(spark, (BOOKS_PENDING, *FIVE_TABLES))
    _complete(spark, tables, BOOKS_PENDING, FIVE_TABLES)
    loaded = tables.read(spark, BRIDGE)
    accepted = star.book_fact(star.checked_books(records), order, existing=loaded)
    tables.replace(accepted, BOOKS_PENDING)
    _complete(spark, tables, BOOKS_PENDING, FIVE_TABLES)


def load_serial(records: DataFrame, order: list[str], tables: CatalogTables) -> None:
    """Records to the five tables of the serial form; ids go on after the last one.

    Books have no other key, so a second run appends the records again. After a
    run that failed on the way, the next one first completes it, then adds its
    own records: to complete it only, hand it none.
    """
    spark: SparkSession = records.sparkSession
    tables.create(spark, (SERIAL_PENDING, *SERIAL_TABLES))
    _complete(spark, tables, SERIAL_PENDING, SERIAL_TABLES)
    last = tables.read(spark, SERIAL_BOOKS).agg(F.max("book_id")).first()[0] or 0
    tables.replace(star.serial_books(star.checked_books(records), order, last), SERIAL_PENDING)
    _complete(spark, tables, SERIAL_PENDING, SERIAL_TABLES)


def delete_rows(
    tables: DividedTables, model: tuple[Table, ...], table: Table, keys: DataFrame
) -> DataFrame:
    """Delete rows by the first key column, as the foreign keys of the model say.

    Children of a cascading key go with their parent, all the way down, and
    before it. A child whose key does not cascade keeps its parents, up to the
    row asked for. Returns the keys that are kept for that, written.
    """
    spark = keys.sparkSession
    asked = keys.select(F.col(keys.columns[0]).alias(table.key[0])).distinct()
    blocked = _written(_blocked(tables, model, table, asked), "blocked")
    gone = _written(asked.join(blocked, table.key[0], "left_anti"), "gone")
    if not gone.isEmpty():
        _delete(spark, tables, model, table, table.key[0], gone)
    return blocked


def _children(model: tuple[Table, ...], table: Table) -> list[tuple[Table, str, str]]:
    """Tables that refer to this one: child, its column, our column."""
    return [(c, own, ours) for c in model for name, own, ours in c.parents if name == table.name]


def _hit(
    tables: DividedTables, table: Table, column: str, keys: DataFrame, wanted: str
) -> DataFrame:
    """Values of ``wanted`` in the rows whose ``column`` is among the keys, with that column."""
    spark = keys.sparkSession
    keys = keys.select(F.col(keys.columns[0]).alias(column))
    rows = tables.of_buckets(spark, table, tables.buckets_of(keys, table, column))
    return rows.join(keys, column, "left_semi").select(
        F.col(column).alias("_key"), F.col(wanted).alias("_wanted")
    )


def _blocked(
    tables: DividedTables, model: tuple[Table, ...], table: Table, keys: DataFrame, column: str = ""
) -> DataFrame:
    """Of the values of ``column``, those with a row below them that does not cascade."""
    column = column or table.key[0]
    found = keys.where("false").select(F.col(keys.columns[0]).alias(column))
    for child, own, ours in _children(model, table):
        pairs = _hit(tables, table, column, keys, ours)
        held = pairs.select(F.col("_wanted").alias(own)).distinct()
        if child.cascade:
            stays = _blocked(tables, model, child, held, own)
        else:
            stays = _hit(tables, child, own, held, own).select(F.col("_key").alias(own))
        stays = stays.select(F.col(own).alias("_wanted")).distinct()
        found = found.union(pairs.join(stays, "_wanted", "left_semi").select("_key"))
    return found.distinct()


def _delete(
    spark: SparkSession,
    tables: DividedTables,
    model: tuple[Table, ...],
    table: Table,
    column: str,
    keys: DataFrame,
) -> None:
    """Children first, so that no child is ever without its parent."""
    for child, own, ours in _children(model, table):
        held = _hit(tables, table, column, keys, ours).select(F.col("_wanted").alias(own))
        _delete(spark, tables, model, child, own, _written(held.distinct(), "held"))
    tables.delete(keys, table, column)


def delete_books(tables: DividedTables, keys: DataFrame) -> None:
    """Books of the three-table model with all that belongs to them.

    The ledger forgets them last: until then a run that stopped is completed by
    the next one, and afterwards the sku may be loaded anew.
    """
    delete_rows(tables, THREE_TABLES, BOOK, keys)
    tables.delete(keys, LEDGER)


def _written(rows: DataFrame, name: str) -> DataFrame:
    """What was decided, before the tables change."""
    path = scratch_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _complete(
    spark: SparkSession, tables: CatalogTables, pending: Table, model: tuple[Table, ...]
) -> None:
    """Add what is pending to all tables. A book's bridge row, written last, marks it as done."""
    have = {t.name: tables.read(spark, t) for t in model}
    books = not_in(tables.read(spark, pending), have[model[-1].name], pending.key)
    if books.isEmpty():
        return
    rows = star.star(books, have, model)
    for table in model:
        tables.append(rows[table.name], table)
