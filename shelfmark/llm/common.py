"""What several operators of this package share: word pattern, written tables, union of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.session import scratch_dir

#: A word: a run of characters that are not ASCII white space. ``bytes.split()`` cuts alike.
WORD = r"[^\x20\x09-\x0D]+"
#: Stands for a null id in comparisons: a null id is greater than every other.
NO_ID = (1 << 63) - 1


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors.

    What was shuffled for it is not needed any more, and goes at once.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def tasks(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: what a task makes of one is bounded by its size."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def beside(docs: DataFrame, **columns) -> DataFrame:
    """``docs`` with its columns by number, as _0_, _1_, ..., and others beside them.

    So no column of a table can clash with those an operator works with.
    """
    own = [F.col(f"`{c}`").alias(f"_{i}_") for i, c in enumerate(docs.columns)]
    return docs.select(*own, *[c.alias(n) for n, c in columns.items()])


def restored(rows: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of ``docs`` under their names, some of them changed."""
    return rows.select(
        *[changed.get(c, F.col(f"_{i}_")).alias(c) for i, c in enumerate(docs.columns)]
    )


def id_key(column: str = "doc_id"):
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def id_from_key(column):
    return F.when(F.col(column) != NO_ID, F.col(column))


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable, after the links a-b joined the classes in ``labels``."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b = a[apart], b[apart]
        low, high = np.minimum(x[apart], y[apart]), np.maximum(x[apart], y[apart])
        np.minimum.at(labels, high, low)
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels = jumped


def components(links: DataFrame) -> DataFrame:
    """Connected components by alternating stars.

    ``links`` has long columns a and b. Returns (node, component) for every node
    of a link; a component is its smallest node. Each round moves all larger
    neighbours, then all smaller ones, of a node to its smallest neighbour, and
    is written to the shared folder, until a round changes nothing. Work is
    joins and minima with partial aggregation; nothing is collected but a
    count and a checksum.
    """
    ordered = links.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b")
    edges = written(ordered.distinct(), "links")
    before = None
    while True:
        state = edges.selectExpr("count(*)", "sum(cast(xxhash64(a, b) AS decimal(38, 0)))").first()
        if state[0] == 0 or tuple(state) == before:
            break
        before = tuple(state)
        both = edges.union(edges.selectExpr("b AS a", "a AS b"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").where("b <> m").selectExpr("b AS a", "m AS b")
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").selectExpr("b AS a", "m AS b")
        edges = written(small.union(least.selectExpr("a", "m AS b")).distinct(), "links")
    nodes = edges.selectExpr("a AS node", "b AS component")
    # Written, so that a join with it is a join of two shuffles, whose hot keys Spark splits.
    return written(
        nodes.union(edges.selectExpr("b AS node", "b AS component").distinct()), "components"
    )
