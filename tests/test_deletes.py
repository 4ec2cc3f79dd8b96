"""Deletes through foreign keys, bucket by bucket."""

import pytest
from pyspark.sql import functions as F
from test_review import _topic

from shelfmark.plans import jobs
from shelfmark.schema import BOOK, BOOK_AUTHOR, DETAIL, THREE_TABLES, Table
from shelfmark.sinks.tables import DividedTables
from shelfmark.streaming.ingest import LEDGER, REJECTED, TableSink, parsed

MODEL = (LEDGER, *THREE_TABLES, REJECTED)
A = Table("a", {"k": "string"}, key=("k",))
B = Table("b", {"k": "string", "a": "string"}, key=("k",), parents=(("a", "a", "k"),), cascade=True)
C = Table("c", {"k": "string", "b": "string"}, key=("k",), parents=(("b", "b", "k"),), cascade=True)
D = Table("d", {"k": "string", "c": "string"}, key=("k",), parents=(("c", "c", "k"),))


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "sku string")


def skus(spark, tables, table):
    return sorted(r[0] for r in tables.read(spark, table).select(table.key[0]).collect())


def test_books_go_with_all_that_is_theirs(spark, tmp_path):
    tables = DividedTables(str(tmp_path / "d"), "del_", 8)
    tables.create(spark, MODEL)
    sink = TableSink(tables)
    names = [f"s{n}" for n in range(12)]
    sink(parsed(_topic(spark, [(0, n, s) for n, s in enumerate(names)])), 0)
    files = {t.name: set(spark.table(tables.name(t)).inputFiles()) for t in MODEL}
    jobs.delete_books(tables, keys(spark, "s3", "s4", "absent", None))
    want = sorted(set(names) - {"s3", "s4"})
    for table in (LEDGER, *THREE_TABLES):
        assert skus(spark, tables, table) == want
        # Buckets without such a row keep their files.
        touched = tables.buckets_of(keys(spark, "s3", "s4", "absent"), table, "sku")
        others = {f for f in files[table.name] if not any(f"/part={p}/" in f for p in touched)}
        assert others <= set(spark.table(tables.name(table)).inputFiles()) and others
    jobs.delete_books(tables, keys(spark, "s3", "s4"))
    assert skus(spark, tables, BOOK) == want
    # A deleted sku may come again; one that is there may not.
    sink(parsed(_topic(spark, [(0, 20, "s3"), (0, 21, "s5")])), 1)
    for table in (LEDGER, *THREE_TABLES):
        assert skus(spark, tables, table) == sorted([*want, "s3"])
    assert [r.src_offset for r in tables.read(spark, REJECTED).collect()] == [21]
    # All rows of a bucket, and all rows.
    jobs.delete_books(tables, keys(spark, *names))
    assert all(skus(spark, tables, t) == [] for t in (LEDGER, *THREE_TABLES))
    tables.compact(spark, *MODEL)
    assert tables.read(spark, REJECTED).count() == 1


def test_only_touched_buckets_are_read(spark, tmp_path):
    tables = DividedTables(str(tmp_path / "p"), "parts_", 8)
    tables.create(spark, MODEL)
    TableSink(tables)(parsed(_topic(spark, [(0, n, f"s{n}") for n in range(9)])), 0)
    parts = tables.buckets_of(keys(spark, "s1"), DETAIL, "sku")
    rows = tables.of_buckets(spark, DETAIL, parts)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert len(parts) == 1 and f"(part#" in plan and f"= {parts[0]})" in plan
    assert len(rows.inputFiles()) == 1
    assert all(f"part={parts[0]}/" in f for f in rows.inputFiles())
    joined = tables.read(spark, BOOK).join(tables.read(spark, BOOK_AUTHOR), "sku")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan


def test_a_delete_that_stopped_is_completed(spark, tmp_path):
    tables = DividedTables(str(tmp_path / "h"), "half_", 4)
    tables.create(spark, MODEL)
    TableSink(tables)(parsed(_topic(spark, [(0, n, f"s{n}") for n in range(5)])), 0)
    whole = tables.delete

    def dies(gone, table, column=None):
        if table is BOOK:
            raise OSError("lost")
        whole(gone, table, column)

    tables.delete = dies
    with pytest.raises(OSError):
        jobs.delete_books(tables, keys(spark, "s1"))
    assert "s1" in skus(spark, tables, BOOK) and "s1" not in skus(spark, tables, DETAIL)
    tables.delete = whole
    jobs.delete_books(tables, keys(spark, "s1"))
    assert all(skus(spark, tables, t) == ["s0", "s2", "s3", "s4"] for t in (LEDGER, *THREE_TABLES))


def test_a_key_that_does_not_cascade_keeps_all_above(spark, tmp_path):
    """a <- b <- c cascade, d holds c: what d reaches stays, up to the row asked for."""
    tables = DividedTables(str(tmp_path / "g"), "graph_", 4)
    model = (A, B, C, D)
    tables.create(spark, model)
    rows = [
        [("a1",), ("a2",), ("a3",), ("a4",)],
        [("b1", "a1"), ("b2", "a1"), ("b3", "a2"), ("b4", None)],
        [("c1", "b1"), ("c2", "b2"), ("c3", "b3"), ("c4", None)],
        [("d1", "c2"), ("d2", None)],
    ]
    for table, values in zip(model, rows, strict=True):
        schema = ", ".join(f"{c} {t}" for c, t in table.columns.items())
        tables.append(spark.createDataFrame(values, schema), table)
    kept = jobs.delete_rows(tables, model, A, keys(spark, "a1", "a2", "a3"))
    assert [r[0] for r in kept.collect()] == ["a1"]
    assert skus(spark, tables, A) == ["a1", "a4"]
    assert skus(spark, tables, B) == ["b1", "b2", "b4"]
    assert skus(spark, tables, C) == ["c1", "c2", "c4"]
    assert skus(spark, tables, D) == ["d1", "d2"]
    assert jobs.delete_rows(tables, model, D, keys(spark, "d1")).isEmpty()
    assert jobs.delete_rows(tables, model, A, keys(spark, "a1")).isEmpty()
    assert [skus(spark, tables, t) for t in model] == [["a4"], ["b4"], ["c4"], ["d2"]]
    assert tables.read(spark, A).where(F.col("k") == "a4").count() == 1
