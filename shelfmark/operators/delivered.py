"""The set of delivered documents as bitmaps by range of ids (O-MARK, P17, S7).

One bit for a document: 32,768 ids share a bitmap of 4 KB. Marks are bitmaps that
are appended; reading merges them by OR, so it does not matter how often an id was
marked, or whether a compaction was cut short. Bitmaps without a gap are known by
their number alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import make_folder, remove

# Fixed value: bits of a bitmap of Spark's bitmap functions.
BITS = 32_768
#: Bitmaps of more bytes than this are met by a shuffle of ids instead of a broadcast.
BROADCAST_BYTES = 64 << 20

_SCHEMA = "bucket long, bits binary"


def bitmaps(ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """(bucket, bits) of the ids; they meet in the tasks first."""
    return (
        ids.where(F.col(column).isNotNull())
        .groupBy(F.bitmap_bucket_number(column).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(column)).alias("bits"))
    )


def merged(marks: DataFrame) -> DataFrame:
    """Each bucket once."""
    return marks.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _has(bits: str, column: str) -> str:
    """Is the bit of this id set?"""
    at = f"bitmap_bit_position({column})"
    byte = f"cast(conv(hex(substring({bits}, cast({at} div 8 AS int) + 1, 1)), 16, 10) AS int)"
    return f"getbit({byte}, cast({at} % 8 AS int)) = 1"


def with_mark(rows: DataFrame, marks: DataFrame, column: str, name: str) -> DataFrame:
    """Rows with a flag: is their id marked? One without an id is not.

    Rows stay where they are while the bitmaps are few enough to be broadcast,
    which is counted. Beyond that only ids meet the bitmaps, and rows the ids
    that are marked.
    """
    known = merged(marks).select("bucket", "bits", F.bitmap_count("bits").alias("_set"))
    # A bitmap without a gap needs no bits.
    known = known.select("bucket", F.when(F.col("_set") < BITS, F.col("bits")).alias("bits"))
    size = known.select(F.sum(16 + F.coalesce(F.octet_length("bits"), F.lit(0)))).first()[0] or 0
    known = known.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    bucket = F.bitmap_bucket_number(column) == F.col("_bucket")
    marked = F.expr(f"_bucket IS NOT NULL AND (_bits IS NULL OR {_has('_bits', column)})")
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(known), bucket, "left").select(*rows.columns, marked.alias(name))
    ids = rows.where(F.col(column).isNotNull()).select(column).distinct()
    hit = ids.join(known, bucket).where(marked).select(column, F.lit(True).alias(name))
    flag = F.coalesce(name, F.lit(False)).alias(name)
    return rows.join(hit, column, "left").select(*rows.columns, flag)


def undelivered(documents: DataFrame, marks: DataFrame, column: str = "doc_id") -> DataFrame:
    """Documents whose id is not marked."""
    flagged = with_mark(documents, marks, column, "_marked")
    return flagged.where("NOT _marked").select(*documents.columns)


class DeliveredMarks:
    """Bitmaps in a folder that all executors share."""

    def __init__(self, folder: str):
        self.folder = folder

    def read(self, spark: SparkSession) -> DataFrame:
        make_folder(spark, self.folder)
        return spark.read.schema(_SCHEMA).parquet(self.folder)

    def mark(self, ids: DataFrame, column: str = "doc_id") -> None:
        bitmaps(ids, column).write.mode("append").parquet(self.folder)

    def with_mark(self, rows: DataFrame, column: str, name: str) -> DataFrame:
        return with_mark(rows, self.read(rows.sparkSession), column, name)

    def undelivered(self, documents: DataFrame, column: str = "doc_id") -> DataFrame:
        return undelivered(documents, self.read(documents.sparkSession), column)

    def compact(self, spark: SparkSession) -> None:
        """One bitmap per range again. Whatever is cut short leaves the same set."""
        marks = self.read(spark)
        old = marks.inputFiles()
        if len(old) > 1:
            merged(marks).write.mode("append").parquet(self.folder)
            for file in old:
                remove(spark, file)
