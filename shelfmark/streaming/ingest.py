"""Topic to typed records to three tables, as a stream (S9, S14, O-3T, T1-T9)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.storagelevel import StorageLevel

from shelfmark.operators import project
from shelfmark.operators.coerce import coerce, type_parsed
from shelfmark.operators.integrity import first_wins, good, not_in, quarantined, row_reasons
from shelfmark.operators.messages import parse_messages
from shelfmark.schema import (
    BOOK,
    BOOK_AUTHOR,
    DETAIL,
    RAW_SCHEMA,
    THREE_TABLES,
    Table,
)
from shelfmark.session import remove, scratch_dir
from shelfmark.sinks.tables import BatchTables, CatalogTables, JdbcTables

ORIGIN = ("partition", "offset")
PROBED = 1000  # keys of a batch up to which they are looked up by value

# Which message a loaded book came from. Read to refuse later copies of a sku
# and to recognise a replay of the same message.
LEDGER = Table(
    "book_origin",
    {"sku": "string", "src_partition": "int", "src_offset": "bigint", "message_id": "string"},
    key=("sku",),
)

# Refused messages, whole, with the reasons.
REJECTED = Table(
    "rejected",
    {
        "message_id": "string",
        "src_partition": "int",
        "src_offset": "bigint",
        "message": "string",
        "reasons": "string",
    },
    key=("message_id",),
)


def message_id(messages: DataFrame) -> Column:
    """What tells a message from every other: a digest of its value, place, topic and time.

    The place alone does not: offsets start again in another topic, or in one
    that was made anew. Topic and time count where the messages have them.
    """
    place = {"topic": "topic", "partition": "partition", "offset": "offset"}
    if "timestamp" in messages.columns:
        place["timestamp"] = "unix_micros(CAST(timestamp AS TIMESTAMP))"
    texts = [f"coalesce(CAST({e} AS STRING), '')" for c, e in place.items() if c in messages.columns]
    head = f"CAST(concat_ws('|', {', '.join(texts)}, '') AS BINARY)"
    return F.expr(f"md5(concat({head}, coalesce(CAST(value AS BINARY), X'')))")


def parsed(messages: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Text record per message, with its origin; the same for batch and stream.

    ``names`` maps our field names to those in the messages, where they differ.
    """
    names = names or {}
    schema = T.StructType(
        [T.StructField(names.get(f.name, f.name), f.dataType) for f in RAW_SCHEMA.fields]
    )
    identity = message_id(messages).alias("message_id")
    rows = parse_messages(messages.select("value", *ORIGIN, identity), schema, keep_as="message")
    return rows.withColumnsRenamed({theirs: ours for ours, theirs in names.items()})


def sink_typed(records: DataFrame, policy: str = "v1") -> DataFrame:
    """Typed record under any policy; v2 reads the numbers of the kept message."""
    return type_parsed(records) if policy == "v2" else coerce(records, policy)


def typed(
    messages: DataFrame, policy: str = "v1", names: dict[str, str] | None = None
) -> DataFrame:
    """Typed record per message, with origin and reasons."""
    return sink_typed(parsed(messages, names), policy)


class TableSink:
    """The ``foreachBatch`` callback: one micro-batch into all tables.

    What to load is decided once per batch, then written parents first.

    ``BatchTables`` show readers whole batches only: each write replaces the
    batch's own partition, and a row written last makes the batch count. A
    batch that is replayed is written anew, or left alone where it counts already.

    Other tables take appends. A book is new if the ledger, written first, does
    not know its sku, so new books are appended as they are. Messages that the
    ledger knows are a replay: of these a table takes the keys it does not have,
    so a batch that failed on the way, or a topic read again from the start,
    completes what is missing and adds nothing twice.

    ``compact_every`` batches all tables are compacted, which bounds their files
    however many small batches there are.
    """

    def __init__(
        self,
        tables: BatchTables | CatalogTables | JdbcTables,
        policy: str = "v1",
        keep_missing_key: bool = False,
        compact_every: int | None = None,
    ):
        self.tables = tables
        self.policy = policy
        self.keep_missing_key = keep_missing_key
        self.compact_every = compact_every
        self.batches = 0

    def _stored(self, table: Table, keys: DataFrame) -> DataFrame:
        """Rows of a table that can have one of these values of its first key column.

        A few are looked up by value, so only their buckets are read; for more
        than ``PROBED`` this is the whole table.
        """
        few = [r[0] for r in keys.where(F.col(table.key[0]).isNotNull()).limit(PROBED + 1).collect()]
        if len(few) > PROBED:
            return self.tables.read(keys.sparkSession, table)
        return self.tables.read_keys(keys.sparkSession, table, few)

    def checked(self, batch: DataFrame) -> DataFrame:
        """Typed rows with what each alone tells against it, and a number for each."""
        numbered = batch.withColumn("_row", F.monotonically_increasing_id())
        typed_rows = sink_typed(numbered, self.policy)
        return row_reasons(typed_rows, THREE_TABLES, "sku", self.keep_missing_key)

    def known(self, rows: DataFrame) -> DataFrame:
        """Ledger rows that can concern these rows."""
        return self._stored(LEDGER, rows.select("sku").distinct())

    def decide(self, rows: DataFrame) -> DataFrame:
        """All rows of a checked batch with final ``reasons``, and ``new`` for books to load.

        ``new`` is true for a book to add, false for the message a loaded book
        came from, null for every other row. A loaded sku keeps its message, so
        only that message passes again; of the messages with another sku the
        first one does. Of one message that is there several times one row passes,
        and the others are not refused.
        """
        place = F.struct(*ORIGIN, "_row").alias("_place")
        # Copies of one message meet in the tasks first.
        one = good(rows).select("sku", "message_id", place)
        one = one.groupBy("sku", "message_id").agg(F.min("_place").alias("_place"))
        won = first_wins(one, ["sku"], ["_place"])
        ledger = self.known(rows).select("sku", F.col("message_id").alias("_loaded"))
        won = won.join(ledger, "sku", "left").select(
            "sku",
            F.coalesce("_loaded", "message_id").alias("message_id"),
            F.col("_loaded").isNull().alias("_new"),
        )
        won = won.join(one, ["sku", "message_id"])
        won = won.select("sku", "message_id", "_new", F.col("_place._row").alias("_first"))
        labelled = rows.join(won, ["sku", "message_id"], "left")
        refused = (F.size("reasons") == 0) & F.col("_new").isNull()
        return (
            labelled.withColumn("new", F.when(F.col("_first") == F.col("_row"), F.col("_new")))
            .withColumn(
                "reasons",
                F.when(refused, F.array(F.lit("duplicate_sku"))).otherwise(F.col("reasons")),
            )
            .drop("_new", "_first", "_row")
        )

    def _refused(self, rows: DataFrame) -> DataFrame:
        """Refused messages that are not stored yet, each once."""
        source = [F.col(o).alias(f"src_{o}") for o in ORIGIN]
        why = F.array_join("reasons", "|").alias("reasons")
        refused = quarantined(rows).select("message_id", *source, "message", why)
        refused = refused.dropDuplicates(["message_id"])
        return not_in(refused, self._stored(REJECTED, refused.select("message_id")), ["message_id"])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = self.tables.batch_name(spark, batch_id) if self.tables.whole else None
        if name and self.tables.holds(spark, name):
            return
        checked = self.checked(batch).persist(StorageLevel.MEMORY_AND_DISK)
        folder = scratch_dir(spark, "batch")

        def fixed(rows: DataFrame, part: str) -> DataFrame:
            """Written, so that what was decided stays as it is when the tables grow."""
            rows.write.parquet(f"{folder}/{part}")
            return spark.read.schema(rows.schema).parquet(f"{folder}/{part}")

        try:
            rows = fixed(self.decide(checked), "rows")
            refused = fixed(self._refused(rows), "refused")
            replayed = not name and not rows.where("NOT new").isEmpty()

            def load(table: Table, made: Callable[[DataFrame], DataFrame]) -> None:
                found = made(rows.where("new"))
                if replayed:
                    again, stored = made(rows.where("NOT new")), self.tables.read(spark, table)
                    found = found.unionByName(not_in(again, stored, table.key))
                self._write(found, table, name)

            source = [F.col(o).alias(f"src_{o}") for o in ORIGIN]
            self._write(rows.where("new").select("sku", *source, "message_id"), LEDGER, name)
            load(BOOK, project.book)
            load(BOOK_AUTHOR, lambda books: project.book_author(books, blank=True))
            load(DETAIL, project.detail)
            self._write(refused, REJECTED, name)
            if name:
                self.tables.commit(spark, name)
            self.batches += 1
            if self.compact_every and self.batches % self.compact_every == 0:
                self.tables.compact(spark, LEDGER, *THREE_TABLES, REJECTED)
        finally:
            checked.unpersist()
            remove(spark, folder)

    def _write(self, rows: DataFrame, table: Table, name: str | None) -> None:
        if name:
            self.tables.put(rows, table, name)
        else:
            self.tables.append(rows, table)


def start(
    messages: DataFrame,
    sink: TableSink,
    checkpoint: str,
    trigger: dict | None = None,
    names: dict[str, str] | None = None,
) -> StreamingQuery:
    """Start the ingest. The checkpoint keeps the offsets and is not optional.

    ``trigger`` is passed on, for example ``{"availableNow": True}``; without
    one, batches follow each other as fast as they come. ``names`` maps our field
    names to those in the messages.
    """
    writer = (
        parsed(messages, names)
        .writeStream.foreachBatch(sink)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def drain(
    spark: SparkSession,
    messages: DataFrame,
    sink: TableSink,
    checkpoint: str,
    names: dict[str, str] | None = None,
) -> None:
    """Load everything that is there now, in as many batches as it takes, and stop."""
    start(messages, sink, checkpoint, {"availableNow": True}, names).awaitTermination()
