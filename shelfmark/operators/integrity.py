"""Keys, foreign keys, limits and rejects as set operators.

Row statements of a database (``ON CONFLICT DO NOTHING``, ``RETURNING``, a
foreign key check, a rolled-back transaction) become joins here. Three rules
keep them whole and even under hot keys:

* rows are cut to one per key inside each task before any shuffle by that key;
* rows that must all be kept are joined on their unique order columns, or with
  hot keys salted (``skew.salted_join``);
* joins with data are not hinted: Spark broadcasts a side only when its
  measured size is under the session's threshold, and splits hot partitions
  otherwise. The one hint is on a table of one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from shelfmark.functions.text import lit, reasons, strip
from shelfmark.operators.skew import salted_join
from shelfmark.schema import MISSING, Table
from shelfmark.session import scratch_dir

_LOCAL_BITS = 33  # monotonically_increasing_id: partition above, row below


def first_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by a total order (K1, K2).

    The rank limit runs before the shuffle as well, so each task sends at most
    one row per key: a hot key costs one row per task.
    """
    by_key = Window.partitionBy(*keys).orderBy(*order)
    ranked = rows.withColumn("_rank", F.row_number().over(by_key))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def not_in(rows: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the target. For rows that hold a key once."""
    return rows.join(target.select(*keys), list(keys), "left_anti")


def insert_if_absent(
    rows: DataFrame, target: DataFrame | None, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Rows to append: one per key, and only keys the target does not have (K3-K5, K7).

    Without an order all columns must be equal per key, so any row will do.
    """
    one = first_wins(rows, keys, order) if order else rows.dropDuplicates(list(keys))
    return one if target is None else not_in(one, target, keys)


def dimension(rows: DataFrame, column: str, target: DataFrame | None = None) -> DataFrame:
    """New members of a dimension: distinct stripped names (K3-K5)."""
    name = strip(f"coalesce({column}, '')")
    names = rows.selectExpr(f"{name} AS name")
    return insert_if_absent(names, target, ["name"])


def number_rows(
    rows: DataFrame, order: Sequence[str], name: str = "id", after: int | Column = 0
) -> DataFrame:
    """Dense ids in order, after a given last id (K6). Null orders come first.

    Whole rows are placed by range, in many tasks, and written to the shared
    folder with their place: counts and ids then see the same partitions even
    if executors are lost. The offsets are one row per partition, and no row
    meets another again, so rows with equal or null orders keep one id each.
    """
    spark = rows.sparkSession
    path = scratch_dir(spark, "numbered")
    # Persisted, because finding the ranges reads the input once more.
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        (
            kept.repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .withColumn("_at", F.monotonically_increasing_id())
            .write.parquet(path)
        )
    finally:
        kept.unpersist()
    placed = spark.read.parquet(path)
    part = F.shiftright("_at", _LOCAL_BITS)
    local = F.col("_at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    last = F.lit(after) if isinstance(after, int) else after
    ids = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    number = (last + F.col("_before") + local + 1).cast("long").alias(name)
    return ids.select(*rows.columns, number)


def with_parent(
    children: DataFrame, parents: DataFrame, columns: dict[str, str], name: str = "has_parent"
) -> DataFrame:
    """Children with a flag: does the parent row exist (K10)?

    ``columns`` maps child columns to parent columns. One pass serves both the
    kept rows and the orphans. Parents are reduced to distinct keys first.
    """
    keys = [F.col(parent).alias(child) for child, parent in columns.items()]
    known = parents.select(*keys).distinct().withColumn(name, F.lit(True))
    flagged = salted_join(children, known, list(columns), "left")
    return flagged.select(*children.columns, F.coalesce(name, F.lit(False)).alias(name))


def kept_children(children: DataFrame, parents: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Children whose parent exists."""
    keys = [F.col(parent).alias(child) for child, parent in columns.items()]
    return salted_join(children, parents.select(*keys), list(columns), "left_semi").select(
        *children.columns
    )


def orphans(children: DataFrame, parents: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Children whose parent does not exist."""
    keys = [F.col(parent).alias(child) for child, parent in columns.items()]
    return salted_join(children, parents.select(*keys), list(columns), "left_anti").select(
        *children.columns
    )


def cascade_delete(children: DataFrame, deleted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Children left when parents are deleted."""
    return orphans(children, deleted, {k: k for k in keys})


def row_reasons(
    rows: DataFrame, tables: Sequence[Table], key: str = "sku", keep_missing_key: bool = False
) -> DataFrame:
    """Add to ``reasons`` what one row alone tells.

    A null key, a key that is the MISSING marker, and texts over the length
    limit of a table they go to.
    """
    limits: dict[str, int] = {}
    for table in tables:
        for column, most in table.limits:
            if column in rows.columns:
                limits[column] = min(most, limits.get(column, most))
    rules = [(f"null_{key}", f"{key} IS NULL")]
    if not keep_missing_key:
        rules.append((f"missing_{key}", f"{key} = {lit(MISSING)}"))
    rules += [(f"too_long_{c}", f"char_length({c}) > {n}") for c, n in limits.items()]
    found = reasons(rules)
    if "reasons" in rows.columns:
        found = f"concat(reasons, {found})"
    kept = [c for c in rows.columns if c != "reasons"]
    return rows.selectExpr(*kept, f"{found} AS reasons")


def _by_verdict(rows: DataFrame, passed: bool) -> DataFrame:
    """Filter on ``reasons`` above the projection that computes it.

    As a plain filter it would be pushed below, and every field that has a
    reason would be computed twice. A filter on a generated column stays.
    """
    verdict = F.explode(F.array(F.size("reasons") == 0)).alias("_passed")
    kept = F.col("_passed") if passed else ~F.col("_passed")
    return rows.select("*", verdict).where(kept).drop("_passed")


def good(rows: DataFrame) -> DataFrame:
    """Rows without a reason against them."""
    return _by_verdict(rows, True)


def quarantined(rows: DataFrame) -> DataFrame:
    """Rows with at least one reason against them (K9)."""
    return _by_verdict(rows, False)


def accept_books(
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    existing: DataFrame | None = None,
) -> DataFrame:
    """Rows that enter all tables; every other row enters none.

    Decided once per key before any write: the first good row of a key wins,
    unless the key is already loaded.
    """
    won = first_wins(good(rows), [key], order)
    return won if existing is None else not_in(won, existing, [key])


def label_duplicates(
    rows: DataFrame, key: str, order: Sequence[str], existing: DataFrame | None = None
) -> DataFrame:
    """All rows, where good rows that ``accept_books`` refuses get a reason.

    Winners are found on key and order columns alone, and come back by the
    unique order columns, so all rows of a hot key stay spread out.
    """
    narrow = good(rows).select(key, *order)
    won = first_wins(narrow, [key], order)
    if existing is not None:
        won = not_in(won, existing, [key])
    won = won.select(*order, F.lit(True).alias("_won"))
    refused = (F.size("reasons") == 0) & F.col("_won").isNull()
    labelled = F.when(refused, F.array(F.lit(f"duplicate_{key}"))).otherwise(F.col("reasons"))
    joined = rows.join(won, list(order), "left").withColumn("reasons", labelled)
    return joined.select(*rows.columns)
