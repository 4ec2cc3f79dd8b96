"""Physical plans: what must and must not be in them."""

import re

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import integrity, links
from shelfmark.plans.queries import QUERIES
from shelfmark.schema import BOOK, DETAIL
from shelfmark.sinks.tables import CatalogTables

PURE = [n for n in QUERIES if n.startswith("q_")]
IN_PYTHON = {"q_tile_links", "q_page_tree", "q_product_fields"}
# A window without a partition, over a bounded number of rows.
BOUNDED_WINDOW = {"q_outbox_batches", "q_outbox_mark", "q_number_nulls", "q_surrogate_key", "q_serial_bridge",
                  "q_serial_books",
                  "q_array_messages"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf):
    return {name: plan(QUERIES[name](spark, sf)) for name in PURE}


@pytest.mark.parametrize("name", PURE)
def test_no_python_and_no_pair_join(plans, name):
    text = plans[name]
    assert ("MapInArrow" in text) == (name in IN_PYTHON)
    assert "PythonUDF" not in text and "BatchEvalPython" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", PURE)
def test_no_unbounded_single_partition(plans, name):
    if name not in BOUNDED_WINDOW:
        assert "Exchange SinglePartition" not in plans[name]


def scanned(text):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*?)>", text)]


@pytest.mark.parametrize(
    "name,columns",
    [
        ("q_clean_units", {"p_partkey"}),
        ("q_domain_filter", {"page_id", "url"}),
        ("q_clean_audience", {"p_partkey", "p_size"}),
        ("q_outbox_pending", {"p_partkey"}),
        ("q_dim_category", {"p_type"}),
    ],
)
def test_scan_reads_only_needed_columns(plans, name, columns):
    for found in scanned(plans[name]):
        assert found == columns


def test_status_filter_reaches_the_scan(plans):
    assert "EqualTo(o_orderstatus,F)" in plans["q_fk_orphans"]


def test_null_safe_filter_reaches_the_scan(spark, tmp_path):
    from shelfmark.operators.outbox import pending
    from shelfmark.schema import DOCUMENT_SCHEMA

    path = str(tmp_path / "docs")
    spark.createDataFrame([], DOCUMENT_SCHEMA).write.parquet(path)
    text = plan(pending(spark.read.parquet(path)).select("doc_id"))
    assert "Not(EqualNullSafe(sent,true))" in text


@pytest.mark.parametrize("name", ["q_pk_first_wins", "q_pk_order_lines", "q_book_fact"])
def test_first_wins_is_cut_before_the_shuffle(plans, name):
    text = plans[name]
    assert re.search(r"WindowGroupLimit .*1, Final", text)
    before = text[text.index("Exchange hashpartitioning") :]
    assert re.search(r"WindowGroupLimit .*1, Partial", before)


def test_distinct_is_cut_before_the_shuffle(spark):
    urls = spark.range(10).select(F.lit("http://a/").alias("url"))
    text = plan(links.frontier(urls))
    assert text.count("HashAggregate") == 2


def test_labelling_shuffles_rows_by_origin_not_by_key(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(100).selectExpr(
        "'hot' AS sku", "id AS seq", "repeat('x', 100) AS body", "array('a') AS reasons"
    ).write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(integrity.label_duplicates(spark.read.parquet(path), "sku", ["seq"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for line in text.splitlines():
        if "hashpartitioning(sku" in line:
            below = text[text.index(line) :]
            scan = re.search(r"ReadSchema: struct<(.*?)>", below).group(1)
            assert "body" not in scan


def test_reason_filter_stays_above_the_projection(spark, sf):
    """Fields with a reason are computed once, not once more in a pushed filter."""
    text = plan(integrity.good(QUERIES["q_quarantine"].__globals__["_checked"](spark, sf)))
    assert text.index("Generate explode") > 0
    below = text[text.index("Generate explode") :]
    assert not re.search(r"[) ]Filter ", below)


def test_children_join_parents_without_a_shuffle(spark, tmp_path):
    tables = CatalogTables(str(tmp_path), "co_", 4)
    tables.create(spark, (BOOK, DETAIL))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(integrity.not_in(tables.read(spark, DETAIL), tables.read(spark, BOOK), BOOK.key))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Exchange" not in text
