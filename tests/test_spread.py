"""Records are made in many tasks, though the parts lie in one row group."""

import pytest
from pyspark.sql import functions as F

from shelfmark.plans import inputs, queries
from shelfmark.plans.queries import QUERIES


def parts(spark, folder, keys):
    rows = spark.createDataFrame([(k,) for k in keys], "p_partkey bigint").selectExpr(
        "p_partkey", "concat('name ', p_partkey) AS p_name", "'Brand#1' AS p_brand",
        "if(p_partkey % 4 = 0, NULL, 'SMALL') AS p_type", "CAST(p_partkey % 50 AS INT) AS p_size",
    )
    rows.coalesce(1).write.parquet(f"{folder}/part.parquet")
    return str(folder)


def per_task(rows):
    return [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("keys", [range(400), [7] * 400], ids=["keys", "one key"])
@pytest.mark.parametrize("made", [inputs.records, inputs.documents, inputs.messages])
def test_no_task_makes_most_records(spark, tmp_path, monkeypatch, made, keys):
    monkeypatch.setattr(inputs, "ROWS", 100, raising=False)
    found = per_task(made(spark, parts(spark, tmp_path, keys)))
    assert sum(found) == 400 and max(found) <= 150


def test_spread_records_are_the_same(spark, tmp_path, monkeypatch):
    folder = parts(spark, tmp_path, [*range(300), *range(100)])
    want = {q: sorted(map(str, QUERIES[q](spark, folder).collect())) for q in ("q_coerce_v2", "j_load_three")}
    monkeypatch.setattr(inputs, "ROWS", 50, raising=False)
    for name, rows in want.items():
        assert sorted(map(str, QUERIES[name](spark, folder).collect())) == rows


def test_torn_stream_reads_messages_of_many_tasks(spark, tmp_path, monkeypatch):
    """The stream's files are those of the tasks that made its messages: each is parsed apart."""
    folder = parts(spark, tmp_path, [*range(400), *range(100)])
    want = sorted(map(str, QUERIES["s_ingest_torn"](spark, folder).collect()))
    made, write = [], queries.write_topic_files

    def written(rows, topic, offset, *more):
        made.append(per_task(rows))
        write(rows, topic, offset, *more)

    monkeypatch.setattr(queries, "write_topic_files", written)
    monkeypatch.setattr(inputs, "ROWS", 100, raising=False)
    assert sorted(map(str, QUERIES["s_ingest_torn"](spark, folder).collect())) == want
    assert [sum(drop) for drop in made] == [250, 250] and max(map(max, made)) <= 100
