"""Keys, foreign keys and rejects against brute force, with hot keys."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.operators import integrity
from shelfmark.operators.coerce import coerce
from shelfmark.operators.skew import hot_keys, salted_join
from shelfmark.operators.star import book_fact, checked_books, star
from shelfmark.schema import MISSING, RAW_FIELDS, RAW_SCHEMA, THREE_TABLES

KEYS = st.sampled_from(["hot", "hot", "hot", "a", "b", "c", None])
ROWS = st.lists(st.tuples(KEYS, st.booleans()), min_size=1, max_size=30)
FEW = settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def frame(spark, rows):
    data = [(k, i, [] if ok else ["bad"]) for i, (k, ok) in enumerate(rows)]
    random.Random(1).shuffle(data)
    return spark.createDataFrame(data, "sku string, seq int, reasons array<string>").repartition(4)


def first_good(rows, taken=()):
    won = {}
    for i, (key, ok) in enumerate(rows):
        if ok and key not in taken:
            won.setdefault(key, i)
    return won


@FEW
@given(rows=ROWS)
def test_accept_and_label_agree_with_brute_force(spark, rows):
    df = frame(spark, rows)
    taken = spark.createDataFrame([("a",)], "sku string")
    want = first_good(rows, {"a"})
    accepted = integrity.accept_books(df, "sku", ["seq"], taken)
    assert {r.sku: r.seq for r in accepted.collect()} == want
    labelled = integrity.label_duplicates(df, "sku", ["seq"], taken).collect()
    assert len(labelled) == len(rows)
    for row in labelled:
        ok = rows[row.seq][1]
        if not ok:
            assert row.reasons == ["bad"]
        elif want.get(row.sku) == row.seq:
            assert row.reasons == []
        else:
            assert row.reasons == ["duplicate_sku"]


@FEW
@given(values=st.lists(st.integers(-50, 50), unique=True, max_size=40), after=st.integers(0, 9))
def test_numbers_are_dense_and_in_order(spark, values, after):
    df = spark.createDataFrame([(v, str(v)) for v in values], "v int, t string").repartition(5)
    rows = integrity.number_rows(df, ["v"], "id", after).collect()
    assert [(r.v, r.t) for r in sorted(rows, key=lambda r: r.id)] == [
        (v, str(v)) for v in sorted(values)
    ]
    assert sorted(r.id for r in rows) == list(range(after + 1, after + 1 + len(values)))


def test_numbers_over_many_partitions(spark):
    df = spark.range(0, 50_000, 5, 16).selectExpr("-id AS p", "id % 3 AS o")
    rows = integrity.number_rows(df, ["o", "p"])
    order = F.row_number().over(integrity.Window.orderBy("o", "p"))
    assert rows.withColumn("want", order).where("id != want").count() == 0
    assert rows.count() == 10_000


def test_composite_key(spark):
    rows = spark.createDataFrame(
        [("s", "A", 2), ("s", "A", 1), ("s", "B", 3), ("t", "A", 4)], "sku string, a string, n int"
    )
    got = integrity.first_wins(rows, ["sku", "a"], ["n"]).collect()
    assert {(r.sku, r.a): r.n for r in got} == {("s", "A"): 1, ("s", "B"): 3, ("t", "A"): 4}


def test_hot_key_keeps_all_rows_and_spreads_them(spark):
    """A third of the rows share one key: labelling drops none of them."""
    rows = spark.range(30_000).select(
        F.expr("IF(id % 3 = 0, 'hot', CAST(id AS STRING))").alias("sku"),
        F.col("id").alias("seq"),
        F.expr("CAST(array() AS array<string>)").alias("reasons"),
    )
    labelled = integrity.label_duplicates(rows, "sku", ["seq"])
    assert integrity.good(labelled).count() == 20_001
    assert integrity.quarantined(labelled).count() == 9_999
    parents = spark.createDataFrame([("hot",), ("1",)], "k string")
    flags = integrity.with_parent(rows, parents, {"sku": "k"}).groupBy("has_parent").count()
    assert {r.has_parent: r["count"] for r in flags.collect()} == {True: 10_001, False: 19_999}


def test_foreign_keys(spark):
    children = spark.createDataFrame([("a", 1), ("a", 2), ("x", 3), (None, 4)], "sku string, n int")
    parents = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    link = {"sku": "k"}
    flags = {r.n: r.has_parent for r in integrity.with_parent(children, parents, link).collect()}
    assert flags == {1: True, 2: True, 3: False, 4: False}
    assert {r.n for r in integrity.kept_children(children, parents, link).collect()} == {1, 2}
    assert {r.n for r in integrity.orphans(children, parents, link).collect()} == {3, 4}
    left = integrity.cascade_delete(children, parents.toDF("sku"), ["sku"])
    assert {r.n for r in left.collect()} == {3, 4}


def test_dimension_is_insert_if_absent(spark):
    rows = spark.createDataFrame([(" A ",), ("A",), ("B\n",), (None,), ("",)], "series string")
    target = spark.createDataFrame([("B",)], "name string")
    assert {r.name for r in integrity.dimension(rows, "series").collect()} == {"A", "B", ""}
    assert {r.name for r in integrity.dimension(rows, "series", target).collect()} == {"A", ""}


def record(**values):
    base = {f: "x" for f in RAW_FIELDS} | {
        "units_sold": "1", "sale_price": "1000", "list_price": "2000", "page_count": "10",
        "length_cm": "2", "width_cm": "1", "weight_g": "100",
    }
    base.update(values)
    return tuple(base[f] for f in RAW_FIELDS)


@pytest.mark.parametrize(
    "values,reasons",
    [
        ({}, []),
        ({"sku": None}, ["null_sku"]),
        ({"sku": MISSING}, ["missing_sku"]),
        ({"title": "t" * 255}, []),
        ({"title": "t" * 256}, ["too_long_title"]),
        ({"title": "ô" * 255}, []),
        ({"description": "d" * 5000}, []),
        ({"sale_price": "abc"}, []),
    ],
)
def test_row_reasons(spark, values, reasons):
    typed = coerce(spark.createDataFrame([record(**values)], RAW_SCHEMA), "v1")
    assert integrity.row_reasons(typed, THREE_TABLES).first().reasons == reasons


def test_missing_key_can_be_kept(spark):
    typed = coerce(spark.createDataFrame([record(sku=MISSING)], RAW_SCHEMA), "v1")
    checked = integrity.row_reasons(typed, THREE_TABLES, keep_missing_key=True)
    assert checked.first().reasons == []


def test_refused_book_leaves_no_dimension(spark):
    rows = [
        record(sku="1", series="S1", authors="A"),
        record(sku="1", series="S2", authors="B"),
        record(sku="2", series="S3", authors="C", units_sold="many"),
        record(sku="3", series=" S1 ", authors="A ", category="c" * 101),
        record(sku="4", series=" S1 ", authors="A "),
    ]
    data = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "seq int, " + ", ".join(f"{f} string" for f in RAW_FIELDS))
    tables = star(book_fact(checked_books(df), ["seq"]))
    got = {name: {tuple(r) for r in part.collect()} for name, part in tables.items()}
    assert got["series"] == {("S1",)} and got["author"] == {("A",)}
    assert got["book_author_bridge"] == {("1", "A"), ("4", "A")}
    assert {b[0] for b in got["books"]} == {"1", "4"}


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    rows = spark.range(0, 20_000, 1, 12).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN 'gone' WHEN id % 77 = 0 THEN NULL "
        "ELSE CAST(id % 500 AS STRING) END AS k",
        "id % 4 AS l",
        "id",
    )
    other = spark.range(300).selectExpr("CAST(id AS STRING) AS k", "id % 4 AS l", "true AS hit")
    hot = spark.range(4).selectExpr("'hot' AS k", "id AS l", "true AS hit")
    other = other.unionByName(hot)
    got = salted_join(rows, other, ["k", "l"], how, salts=5)
    want = rows.join(other, ["k", "l"], how)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_salted_join_of_keys_of_two_types(spark):
    rows = spark.range(0, 3_000, 1, 4).selectExpr("CAST(IF(id % 3 = 0, 7, id) AS INT) AS k")
    other = spark.createDataFrame([(7,), (2**40,)], "k long")
    assert salted_join(rows, other, ["k"], "left_semi").count() == 1_001


def test_hot_keys_are_found_and_spread(spark):
    rows = spark.range(0, 90_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS k"
    )
    hot = list(hot_keys(rows, ["k"]))
    assert hot == [spark.sql("SELECT xxhash64('hot')").first()[0]]
    assert hot_keys(rows.limit(0), ["k"]) == {}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        other = spark.createDataFrame([("hot", True)], "k string, hit boolean")
        sizes = (
            salted_join(rows, other, ["k"], "left")
            .groupBy(F.spark_partition_id().alias("task"))
            .agg(F.count_if(F.col("k") == "hot").alias("hot"))
            .collect()
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r.hot for r in sizes) == 30_000
    assert max(r.hot for r in sizes) < 30_000 * 0.6
    assert sum(1 for r in sizes if r.hot) >= 4
