"""Message topics, as a batch or a stream.

The connector is a format name and options. Where no broker is at hand, a
folder of files with the topic's columns serves as the topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.schema import TOPIC_SCHEMA

# Fixed value: messages read by one bounded look at the topic.
PEEK = 100


def topic_options(
    servers: str,
    topic: str,
    starting: str = "earliest",
    fail_on_data_loss: bool = True,
    max_per_batch: int | None = None,
    min_partitions: int | None = None,
    ending: str | None = None,
    from_time: int | None = None,
    to_time: int | None = None,
) -> dict[str, str]:
    """Reader options of a broker topic.

    ``starting`` is ``earliest`` or ``latest``. ``min_partitions`` splits the
    read into more tasks than the topic has partitions. ``starting`` and
    ``ending`` may also be the connector's JSON of offsets by partition;
    ``from_time`` and ``to_time`` (ms since 1970) bound a read by message time.
    An end holds for batch reads only.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if ending:
        options["endingOffsets"] = ending
    if from_time is not None:
        options["startingTimestamp"] = str(from_time)
    if to_time is not None:
        options["endingTimestamp"] = str(to_time)
    if max_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def stream_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Unbounded topic read from a broker."""
    return spark.readStream.format("kafka").options(**options).load()


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Bounded topic read from a broker, up to the newest offset."""
    return spark.read.format("kafka").options(**options).load()


def stream_topic_files(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """Unbounded read of a folder that stands for a topic."""
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_topic_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOPIC_SCHEMA).parquet(path)


def peek(messages: DataFrame, most: int = PEEK) -> DataFrame:
    """The first messages by partition and offset."""
    value = F.col("value").cast("string").alias("value")
    first = messages.select("partition", "offset", "value").orderBy("partition", "offset")
    # The one partition of a top-k stays as it is; this only keeps later projections, such as
    # a parse, from moving between limit and sort, where they would turn it into a full sort.
    return first.limit(most).coalesce(1).select("partition", "offset", value)
