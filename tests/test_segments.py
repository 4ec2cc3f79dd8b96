"""Reads of a topic by ranges of offsets and times."""

import json

import pytest
from pyspark.sql import functions as F

from shelfmark.sources.segments import SegmentedTopic, TopicCursor, range_options


@pytest.fixture
def topic(spark, tmp_path):
    made = SegmentedTopic(f"{tmp_path}/topic", size=10)
    rows = spark.range(95).selectExpr(
        "CAST(NULL AS BINARY) AS key", "CAST(CAST(id AS STRING) AS BINARY) AS value", "id"
    )
    for low, high in ((0, 40), (40, 95)):
        part = rows.where(f"id >= {low} AND id < {high}")
        made.write(part, F.expr("id % 3"), F.expr("id div 3"), F.timestamp_millis("id"))
    return made


def places(df):
    return sorted((r.partition, r.offset) for r in df.collect())


def every(low=0, high=95):
    return sorted((i % 3, i // 3) for i in range(low, high))


def test_ranges(spark, topic):
    assert places(topic.read(spark)) == every()
    ranges = {0: (5, 12), 2: (25, None), 7: (0, 9)}
    want = [p for p in every() if p[0] == 0 and 5 <= p[1] < 12 or p[0] == 2 and p[1] >= 25]
    assert places(topic.read(spark, ranges)) == want
    assert places(topic.read(spark, {})) == []
    assert places(topic.read(spark, {0: (4, 4)})) == []
    assert places(topic.read(spark, None, 10, 20)) == every(10, 20)
    both = topic.read(spark, {1: (0, 100)}, from_time=50)
    assert places(both) == [p for p in every(50) if p[0] == 1]


def test_files_outside_the_range_are_not_opened(spark, topic, tmp_path):
    """All other files are broken: a read that opened one would fail."""
    for file in (tmp_path / "topic").rglob("*.parquet"):
        if "partition=0/segment=1" not in str(file):
            file.write_bytes(b"broken")
    for crc in (tmp_path / "topic").rglob(".*.crc"):
        crc.unlink()
    assert places(topic.read(spark, {0: (12, 15)})) == [(0, 12), (0, 13), (0, 14)]
    with pytest.raises(Exception, match="(?i)parquet|corrupt|footer"):
        topic.read(spark, {0: (9, 15)}).collect()


def test_ends_and_cursor(spark, topic, tmp_path):
    assert topic.ends(spark) == {0: 32, 1: 32, 2: 31}
    cursor, seen, runs = TopicCursor(f"{tmp_path}/cursor"), [], 0
    while ranges := cursor.next_ranges(spark, topic, 13):
        again = places(topic.read(spark, ranges))
        # Not committed: the same range again.
        assert cursor.next_ranges(spark, topic, 13) == ranges
        seen += again
        cursor.commit(spark, ranges)
        runs += 1
    assert sorted(seen) == every() and runs == 3
    more = spark.range(1).selectExpr("CAST(NULL AS BINARY) AS key", "X'01' AS value", "id")
    topic.write(more, F.lit(1), F.lit(32), F.timestamp_millis(F.lit(999)))
    assert cursor.next_ranges(spark, topic, 13) == {1: (32, 33)}
    # A position that was not written whole does not count.
    (tmp_path / "cursor" / "9").mkdir()
    assert cursor.position(spark) == {0: 32, 1: 32, 2: 31}
    empty = SegmentedTopic(f"{tmp_path}/none")
    assert empty.ends(spark) == {} and empty.read(spark).count() == 0


def test_options_of_a_broker():
    options = range_options("t", {1: (5, None), 0: (0, 9)})
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 0, "1": 5}}
    assert json.loads(options["endingOffsets"]) == {"t": {"0": 9, "1": -1}}
