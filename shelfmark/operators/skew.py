"""Joins on a key that may repeat without bound.

A key that holds a third of all rows would send a third of the data to one
task. Spark splits such a partition at run time only if both join sides come
straight from a shuffle, which a side that was just made distinct does not. So
the few keys that can be that hot are found first and salted; all other rows
keep one salt and join as usual. The result does not depend on which keys are
found, as both sides use one answer: a key that is missed is only slower.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1000  # at most this many keys are salted: any other holds less than 0.1 % of the rows
SALTS = 64  # parts of a hot key, at least
_PIECES = 4  # parts of a hot key for each average partition it would fill
_TRACKED = 16384  # size of a sketch: finds keys above about 0.02 % of the rows
_GROUPS = 256  # sketches are merged in this many groups before the last step


def hot_keys(rows: DataFrame, keys: Sequence[str], salts: int = SALTS) -> dict[int, int]:
    """Hashes of the keys that fill more than a quarter of an average partition, and their parts.

    Reads the key columns only. Each task keeps a sketch of fixed size; tasks
    are merged in groups, and each group hands on its most frequent keys. The
    parts of a key grow with its share of the rows and with the partitions. The
    answer, ``HOT_KEYS`` numbers at most, is fetched once, so both sides of a
    join agree on it.
    """
    hashed = f"xxhash64({', '.join(keys)})"
    found = (
        rows.selectExpr(f"pmod(spark_partition_id(), {_GROUPS}) AS part", f"{hashed} AS hash")
        .groupBy("part")
        .agg(F.expr(f"approx_top_k(hash, {HOT_KEYS}, {_TRACKED})").alias("top"), F.expr("count(*) AS n"))
        # All rows of the group, under no key.
        .selectExpr("inline(concat(top, array(named_struct('item', bigint(NULL), 'count', n))))")
        .groupBy("item")
        .agg(F.sum("count").alias("rows"))
        .orderBy(F.desc("rows"), F.asc_nulls_first("item"))
        .limit(HOT_KEYS + 1)
        .collect()
    )
    if not found:
        return {}
    total = found[0].rows
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    filled = {r.item: r.rows / total * partitions for r in found[1:]}
    return {k: max(salts, ceil(_PIECES * share)) for k, share in filled.items() if share > 0.25}


def salted_join(
    rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str, salts: int = SALTS
) -> DataFrame:
    """Join where ``rows`` may repeat a key; ``how`` is left, left_semi or left_anti.

    ``other`` holds the key columns and whatever the join should add. The salt
    comes from the row's columns and its input partition: rows that lie together
    spread by their columns, copies of one row by where they lie, and a task
    that is run again gives each row the same salt. Hashes are equal only
    for equal types, so the keys of ``other`` take the types of ``rows``.
    """
    types = {f.name: f.dataType for f in rows.schema.fields}
    other = other.withColumns({k: F.col(k).try_cast(types[k]) for k in keys})
    hot = hot_keys(rows, keys, salts)
    parts = F.lit(1)
    if hot:
        found = ", ".join(f"{k}L, {n}" if k >= 0 else f"bigint('{k}'), {n}" for k, n in hot.items())
        parts = F.coalesce(F.element_at(F.expr(f"map({found})"), F.xxhash64(*keys)), F.lit(1))
    hashable = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    spread_by = F.xxhash64(*[f"`{c}`" for c in hashable], F.spark_partition_id())
    salt = F.pmod(spread_by, parts).cast("int")
    copies = F.sequence(F.lit(0), parts - 1)
    spread = rows.withColumn("_salt", salt)
    copied = other.withColumn("_salt", F.explode(copies))
    return spread.join(copied, [*keys, "_salt"], how).drop("_salt")
