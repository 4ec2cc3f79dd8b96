"""Messages: parsing, bad input, arrays, publishing, topics."""

import json

from pyspark.sql import functions as F

from shelfmark.operators import project
from shelfmark.operators.integrity import number_rows
from shelfmark.operators.messages import (
    array_frame,
    explode_arrays,
    parse_messages,
    publish_frame,
)
from shelfmark.schema import RAW_FIELDS, RAW_SCHEMA, message_names
from shelfmark.sources.topic import peek, topic_options

GOOD = '{"title": "T\\u00f4i", "sku": "S1", "other": 1}'


def parse(spark, values):
    rows = spark.createDataFrame(list(enumerate(values)), "n int, value string")
    return parse_messages(rows, keep_as="message").orderBy("n").collect()


def test_bad_messages_are_told_apart(spark):
    values = [GOOD, "not json", '{"title": "x"', "", None, "[" + GOOD + "]", "{}", '{"x": 1}']
    rows = parse(spark, values)
    assert [r.message for r in rows] == values
    assert [r.reasons for r in rows] == [
        [],
        ["broken_json"],
        ["broken_json"],
        ["empty_message"],
        ["empty_message"],
        ["broken_json"],
        ["no_known_field"],
        ["no_known_field"],
    ]
    assert (rows[0].title, rows[0].sku, rows[0].isbn) == ("Tôi", "S1", None)


def test_binary_values(spark):
    rows = spark.createDataFrame([(bytearray(GOOD, "utf-8"),)], "value binary")
    assert parse_messages(rows).first().title == "Tôi"


def test_publish_drops_id_and_flag(spark):
    schema = "doc_id int, sent boolean, a string, b string"
    rows = spark.createDataFrame([(1, True, "ô", None)], schema)
    row = publish_frame(rows).first()
    assert row.key is None
    assert json.loads(row.value.decode()) == {"a": "ô"}


def test_array_messages_have_at_most_fifty_records(spark):
    rows = spark.range(117).select(
        F.col("id").alias("doc_id"), *[F.col("id").cast("string").alias(f) for f in RAW_FIELDS]
    )
    arrays = array_frame(number_rows(rows, ["doc_id"], "n"), "n", 50, ("doc_id",)).collect()
    sizes = {r.batch: len(json.loads(r.value)) for r in arrays}
    assert sizes == {0: 50, 1: 50, 2: 17}
    frame = spark.createDataFrame([(r.batch, r.value) for r in arrays], "batch long, value string")
    back = explode_arrays(frame).orderBy("batch", "pos").collect()
    assert [r.sku for r in back] == [str(i) for i in range(117)]


def test_array_is_not_read_as_object(spark):
    """A struct schema on an array message gives no fields: it needs the array form."""
    assert parse(spark, ["[" + GOOD + "]"])[0].title is None


def test_crawler_names(spark):
    names = message_names("maSach")
    assert set(names) == set(RAW_FIELDS)
    theirs = {v: k for k, v in names.items()}
    row = spark.createDataFrame([tuple(names.values())], list(names.values()))
    assert project.renamed(row, theirs).first().asDict() == names


def test_peek_is_by_offset_within_partition(spark):
    rows = spark.range(300).select(
        F.col("id").cast("string").cast("binary").alias("value"),
        (F.col("id") % 2).cast("int").alias("partition"),
        (300 - F.col("id")).alias("offset"),
    )
    first = peek(rows).collect()
    assert [(r.partition, r.offset) for r in first] == [(0, 2 * i) for i in range(1, 101)]


def test_topic_options():
    assert topic_options("h:1", "books") == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "books",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    options = topic_options("h:1", "books", "latest", False, 1000, 64)
    assert options["startingOffsets"] == "latest" and options["failOnDataLoss"] == "false"
    assert options["maxOffsetsPerTrigger"] == "1000" and options["minPartitions"] == "64"


def test_schema_has_sixteen_text_fields():
    assert len(RAW_SCHEMA.fields) == 16


def test_ascii_messages(spark):
    rows = spark.createDataFrame([("ô",)], "title string")
    assert publish_frame(rows, ascii_only=True).first().value.decode() == '{"title":"\\u00F4"}'
    assert parse_messages(publish_frame(rows, ascii_only=True)).first().title == "ô"


def test_decimals(spark):
    numbers = ("sale_price", "list_price", "length_cm", "width_cm")
    schema = ", ".join(["sku string", *[f"{n} double" for n in numbers]])
    rows = spark.createDataFrame([("s", 25000.5, None, 1.005, 20.3)], schema)
    row = project.with_decimals(rows).first()
    assert [str(v) for v in row] == ["s", "25000.50", "None", "1.01", "20.30"]
