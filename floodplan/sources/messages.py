"""Message streams: Kafka topics, or folders of JSON lines in their place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

EVENTS_TOPIC = "events"
UPDATES_TOPIC = "updates"
# What one trigger may take in, so that no batch is unbounded.
MAX_OFFSETS = 1_000_000
MAX_FILES = 100


def kafka_event_id() -> Column:
    """A record's place in its topic as one number, to order records of equal time."""
    return F.shiftleft(F.col("partition").cast("bigint"), 44) + F.col("offset")


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str = EVENTS_TOPIC,
    max_offsets: int = MAX_OFFSETS,
    **options: str,
) -> DataFrame:
    """Messages of a topic: key and value as text, and event_id.

    From the earliest that the topic holds, unless ``startingOffsets`` says otherwise. Needs the Kafka connector package on the session's class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("maxOffsetsPerTrigger", max_offsets)
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    return reader.load().select(
        F.col("key").cast("string"),
        F.col("value").cast("string"),
        kafka_event_id().alias("event_id"),
    )


def read_message_files(
    spark: SparkSession, path: str, max_files: int = MAX_FILES, schema: str | None = None
) -> DataFrame:
    """Messages of a growing folder of JSON lines with key and value (and event_id)."""
    schema = schema or "key string, value string, event_id bigint"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(path)


def write_kafka(
    messages: DataFrame, servers: str, checkpoint: str, topic: str = UPDATES_TOPIC
) -> DataStreamWriter:
    """A writer of key and value to a topic; the caller sets the trigger and starts it."""
    return (
        messages.select("key", "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def write_message_files(messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """A writer of JSON lines; the caller sets the trigger and starts it."""
    return (
        messages.writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
