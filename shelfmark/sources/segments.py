"""Bounded reads of a topic by offset and time, partition by partition.

A broker takes ranges as reader options (``range_options``). A folder that stands
for a topic holds each partition in segments of offsets, so a range names the
folders it needs and no other file is opened. A cursor keeps where the next read
begins.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import make_folder, names_in

#: Offsets [from, to) of each partition; an open end is None.
Ranges = dict[int, tuple[int, int | None]]

_SCHEMA = "key binary, value binary, offset long, timestamp timestamp, partition int, segment long"
_LATEST = -1  # Fixed value: how the connector writes an open end.


def range_options(topic: str, ranges: Ranges) -> dict[str, str]:
    """Options of a broker read for these ranges, beside those of ``topic_options``.

    The connector wants all partitions of the topic in both.
    """
    starts = {str(p): low for p, (low, _) in sorted(ranges.items())}
    ends = {str(p): _LATEST if high is None else high for p, (_, high) in sorted(ranges.items())}
    return {
        "startingOffsets": json.dumps({topic: starts}),
        "endingOffsets": json.dumps({topic: ends}),
    }


class SegmentedTopic:
    """A folder with the messages of a topic: ``partition=<p>/segment=<offset div size>``."""

    def __init__(self, folder: str, size: int = 1_000_000):
        self.folder, self.size = folder, size

    def write(self, rows: DataFrame, partition: Column, offset: Column, time: Column) -> None:
        """Append messages (key, value); one file per segment that they fall into."""
        placed = rows.select(
            "key",
            "value",
            offset.cast("long").alias("offset"),
            time.cast("timestamp").alias("timestamp"),
            partition.cast("int").alias("partition"),
        ).withColumn("segment", F.expr(f"offset div {self.size}"))
        placed = placed.repartition("partition", "segment").sortWithinPartitions("offset")
        placed.write.partitionBy("partition", "segment").mode("append").parquet(self.folder)

    def read(
        self,
        spark: SparkSession,
        ranges: Ranges | None = None,
        from_time: int | None = None,
        to_time: int | None = None,
    ) -> DataFrame:
        """Messages of the ranges, and of the time [from, to) in ms since 1970.

        Without ranges all partitions are read. Segments are chosen before any file is
        opened; offsets and times then skip parts of files by their statistics.
        """
        make_folder(spark, self.folder)
        rows = spark.read.schema(_SCHEMA).parquet(self.folder)
        if ranges is not None:
            wanted = [self._within(p, low, high) for p, (low, high) in sorted(ranges.items())]
            rows = rows.where(" OR ".join(wanted) or "false")
        if from_time is not None:
            rows = rows.where(f"timestamp >= timestamp_millis({int(from_time)})")
        if to_time is not None:
            rows = rows.where(f"timestamp < timestamp_millis({int(to_time)})")
        return rows.select("key", "value", "partition", "offset", "timestamp")

    def _within(self, partition: int, low: int, high: int | None) -> str:
        test = f"partition = {partition} AND segment >= {low // self.size} AND offset >= {low}"
        if high is not None:
            test += f" AND segment <= {max(high - 1, 0) // self.size} AND offset < {high}"
        return f"({test})"

    def ends(self, spark: SparkSession) -> dict[int, int]:
        """The offset behind the last message of each partition, from its last segment alone."""
        last = {}
        for name in names_in(spark, self.folder):
            if name.startswith("partition="):
                segments = names_in(spark, f"{self.folder}/{name}")
                numbers = [int(s.split("=")[1]) for s in segments if s.startswith("segment=")]
                if numbers:
                    last[int(name.split("=")[1])] = max(numbers)
        if not last:
            return {}
        tails: Ranges = {p: (s * self.size, None) for p, s in last.items()}
        found = self.read(spark, tails).groupBy("partition").agg(F.max("offset").alias("last"))
        return {r.partition: r.last + 1 for r in found.collect()}


class TopicCursor:
    """Where the next bounded read begins, in a folder that outlives the job."""

    def __init__(self, folder: str):
        self.folder = folder

    def _last(self, spark: SparkSession) -> int:
        """Number of the last position that was written whole; 0 for none."""
        whole = [
            int(n)
            for n in names_in(spark, self.folder)
            if n.isdigit() and "_SUCCESS" in names_in(spark, f"{self.folder}/{n}")
        ]
        return max(whole, default=0)

    def position(self, spark: SparkSession) -> dict[int, int]:
        last = self._last(spark)
        if not last:
            return {}
        rows = spark.read.schema("partition int, next long").parquet(f"{self.folder}/{last}")
        return {r.partition: r.next for r in rows.collect()}

    def next_ranges(self, spark: SparkSession, topic: SegmentedTopic, most: int) -> Ranges:
        """Up to ``most`` messages of every partition that has some; none when all is read."""
        at = self.position(spark)
        ranges = {}
        for partition, end in topic.ends(spark).items():
            low = at.get(partition, 0)
            if low < end:
                ranges[partition] = (low, min(low + most, end))
        return ranges

    def commit(self, spark: SparkSession, ranges: Ranges) -> None:
        """The ranges are done. To be called after their messages are safe: at least once."""
        at = self.position(spark) | {p: high for p, (_, high) in ranges.items() if high is not None}
        rows = spark.createDataFrame(sorted(at.items()), "partition int, next long")
        path = f"{self.folder}/{self._last(spark) + 1}"
        rows.coalesce(1).write.mode("overwrite").parquet(path)
