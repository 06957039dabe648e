"""Message streams: ``(seq BIGINT, value STRING)`` rows in arrival order.

Offline the stream is a message log (``sources.message_log``), whose offsets are message
numbers, or a directory of Parquet files (the file source replays them oldest
first by their file times; ``maxFilesPerTrigger`` bounds each micro-batch). With a
Kafka connector on the classpath the same shape comes from
``kafka_message_stream``: ``value`` cast to text and the partition offset as
``seq``, which orders a symbol's messages only if the topic is keyed by symbol
(or has one partition). Offsets live in the query checkpoint, which replaces the consumer
group's committed offsets and also holds the operator state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = "seq bigint, value string"


def file_message_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(path)


def kafka_message_stream(spark: SparkSession, servers: str, topic: str,
                         max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Replay a topic from the earliest offset (needs the Kafka connector jar)."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", "earliest"))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().select(F.col("offset").alias("seq"), F.col("value").cast("string").alias("value"))
