"""Topic writers (O-PUB)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_topic(rows: DataFrame, servers: str, topic: str) -> None:
    """Send key and value rows to a broker; all replicas confirm."""
    rows.write.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all"}
    ).save()


def write_topic_files(rows: DataFrame, path: str, offset: Column, partition: int = 0) -> None:
    """Append rows to a folder that stands for a topic; the caller gives offsets."""
    rows.select(
        "key",
        "value",
        F.lit(partition).cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
    ).write.mode("append").parquet(path)
