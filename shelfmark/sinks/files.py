"""File exports and the landing store (O-CSV, O-JSON, O-DOC, O-CHAIN)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from shelfmark.functions.text import reasons, strip
from shelfmark.operators.integrity import good, quarantined
from shelfmark.schema import CSV_COLUMNS, RAW_FIELDS
from shelfmark.session import create_new, move, names_in, remove

_BOM = "\ufeff"


def csv_frame(
    records: DataFrame, columns: tuple[tuple[str, str], ...] = CSV_COLUMNS, bom: bool = False
) -> DataFrame:
    """Stripped fields in export order under their headings."""
    labels = [label for _, label in columns]
    if bom:
        labels[0] = _BOM + labels[0]
    fields = [name for name, _ in columns]
    return records.selectExpr(*[f"{strip(f)} AS `{n}`" for f, n in zip(fields, labels)])


def write_csv(records: DataFrame, path: str, bom: bool = False) -> None:
    """One headed file per task; quotes are doubled, only where needed (O-CSV)."""
    csv_frame(records, bom=bom).write.mode("overwrite").csv(
        path, header=True, quote='"', escape='"', encoding="UTF-8", emptyValue=""
    )


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """The export read back under our names; multi-line fields are kept whole."""
    names = ", ".join(f"{name} string" for name, _ in CSV_COLUMNS)
    return spark.read.schema(names).csv(
        path, header=True, quote='"', escape='"', multiLine=True, enforceSchema=True
    )


def write_json(records: DataFrame, path: str) -> None:
    """One object per line, null keys kept, text literal (O-JSON)."""
    records.select(*RAW_FIELDS).write.mode("overwrite").json(path, ignoreNullFields=False)


def append_documents(records: DataFrame, path: str, after: int = -1) -> None:
    """Append records as unsent documents with new ids (O-DOC).

    Ids are unique and grow with task and row; they are not dense, so no
    shuffle is needed. There is no check for copies: a second crawl appends.
    """
    ids = F.lit(after + 1) + F.monotonically_increasing_id()
    documents = records.select(
        ids.alias("doc_id"), *RAW_FIELDS, F.lit(None).cast("boolean").alias("sent")
    )
    documents.write.mode("append").parquet(path)


def last_document(spark: SparkSession, path: str) -> int:
    """The greatest id of the stored documents; -1 where there is none yet."""
    try:
        stored = spark.read.schema("doc_id long").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1
    found = stored.agg(F.max("doc_id")).first()[0]
    return -1 if found is None else found


#: Ids of one block: 2 to the power 33 for each of 131,072 tasks.
BLOCK = 1 << 50


def claim_block(spark: SparkSession, store: str) -> int:
    """Number of a block of document ids that no other crawl has, also one at the same time.

    A block is claimed by making its file, which only one caller can. The first
    one begins behind the greatest id of a store that has no such files yet.
    """
    folder = f"{store}/_ids"
    taken = [int(n) for n in names_in(spark, folder) if n.isdigit()]
    number = max(taken) + 1 if taken else last_document(spark, store) // BLOCK + 1
    while not create_new(spark, f"{folder}/{number}"):
        number += 1
    return number


def land(
    records: DataFrame,
    folder: str,
    after: int | None = None,
    bom: bool = False,
    store: str | None = None,
) -> None:
    """All sinks from one persisted frame, after one check (O-CHAIN).

    Ids go on after ``after``; without it each crawl claims a block of ids, and
    brings its files in by itself, so that crawls may run at once into one
    ``store`` (by default ``documents`` in the folder; CSV and JSON are of the
    folder's last crawl). Rejected records are added to earlier ones.

    A record with an absent field fails the first sink and therefore reaches
    none; such records go to ``rejected`` with the reason.
    """
    spark = records.sparkSession
    rules = [(f"absent_{f}", f"{f} IS NULL") for f in RAW_FIELDS]
    checked = records.selectExpr(*RAW_FIELDS, f"{reasons(rules)} AS reasons")
    checked.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        passed = good(checked)
        write_csv(passed, f"{folder}/csv", bom)
        write_json(passed, f"{folder}/json")
        store = store or f"{folder}/documents"
        if after is None:
            block = claim_block(spark, store)
            # More tasks than a block has ids for are merged; a lesser number stays as it is.
            placed, side = passed.coalesce(BLOCK >> 33), f"{store}/_crawl-{block}"
            append_documents(placed, side, block * BLOCK - 1)
            # Two jobs cannot append to one folder at once: each writes beside it, out of sight
            # of readers, and moves its files, whose names are its own.
            for name in names_in(spark, side):
                if name.startswith("part-"):
                    move(spark, f"{side}/{name}", f"{store}/{name}")
            remove(spark, side)
        else:
            append_documents(passed, store, after)
        quarantined(checked).write.mode("append").json(f"{folder}/rejected")
    finally:
        checked.unpersist()
