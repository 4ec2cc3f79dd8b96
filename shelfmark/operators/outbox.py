"""Outbox: unsent documents, bounded rounds, delivery marks (S7, S8, O-MARK).

Delivery is at least once: ids are recorded only after the messages are out.
The marks are a table of delivered ids that only grows, so nothing is
rewritten; a document counts as delivered by its own flag or by that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators.integrity import not_in

# Documents per round and rounds per run.
ROUND_SIZE = 50
ROUNDS = 5


def pending(documents: DataFrame, delivered: DataFrame | None = None) -> DataFrame:
    """Documents not sent yet; an absent flag counts as unsent."""
    unsent = documents.where(~F.col("sent").eqNullSafe(True))
    return unsent if delivered is None else not_in(unsent, delivered, ["doc_id"])


def rounds(unsent: DataFrame, size: int = ROUND_SIZE, count: int = ROUNDS) -> DataFrame:
    """The bounded run: first ``size * count`` documents by id, with their round.

    The limit is the feature here, and bounds the window below it. A run
    without a limit publishes ``pending`` as it is.
    """
    bounded = unsent.orderBy("doc_id").limit(size * count)
    place = F.row_number().over(Window.orderBy("doc_id"))
    return bounded.withColumn("round", F.floor((place - 1) / size).cast("int"))


def bounded_run(
    documents: DataFrame,
    delivered: DataFrame | None = None,
    size: int = ROUND_SIZE,
    count: int = ROUNDS,
) -> DataFrame:
    """Whole documents of one bounded run, with their round.

    Chosen by id and flag alone. The ids are at most ``size * count`` rows; Spark
    broadcasts them, so that documents are not shuffled, if they are few enough.
    """
    flags = documents.select("doc_id", "sent")
    ids = rounds(pending(flags, delivered), size, count).select("doc_id", "round")
    return documents.join(ids, "doc_id")


def mark_delivered(documents: DataFrame, delivered: DataFrame) -> DataFrame:
    """Documents with the flag set for delivered ids, others as they were (O-MARK, P17)."""
    ids = delivered.select("doc_id").distinct().withColumn("_hit", F.lit(True))
    flag = F.when(F.col("_hit"), F.lit(True)).otherwise(F.col("sent"))
    return (
        documents.join(ids, "doc_id", "left")
        .withColumn("sent", flag)
        .select(*documents.columns)
    )
