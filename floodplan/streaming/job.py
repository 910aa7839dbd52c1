"""A job to submit: arrivals from one topic, updates to another."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from floodplan.functions.checks import check_window
from floodplan.session import settle
from floodplan.sources.files import read_city_features
from floodplan.sources.messages import (
    EVENTS_TOPIC,
    UPDATES_TOPIC,
    read_kafka,
    write_kafka,
    write_message_files,
)
from floodplan.streaming.live import keep_live
from floodplan.streaming.ranged import track_messages
from floodplan.streaming.tracker import (
    EVENT_TIME,
    PROCESSING_TIME,
    encode_updates,
    parse_events,
    track_refugees,
)
from floodplan.streaming.updates import enrich_updates, large_cities, parse_updates


def updates_of(
    messages: DataFrame, window_seconds: int, time_mode: str, watermark: str
) -> tuple[DataFrame, DataFrame]:
    """(update messages, malformed messages) of a stream of arrival messages."""
    arrivals, malformed = parse_events(messages)
    updates = track_refugees(arrivals, window_seconds, time_mode, watermark)
    return encode_updates(updates), malformed


def run(
    spark: SparkSession,
    servers: str,
    window_seconds: int,
    checkpoint: str,
    time_mode: str = PROCESSING_TIME,
    watermark: str = "1 millisecond",
    trigger: str = "500 milliseconds",
    **options: str,
) -> list[StreamingQuery]:
    """Start the tracker on Kafka; malformed messages go to a folder of their own.

    Further options go to the source.
    """
    window_seconds = check_window(window_seconds)
    messages = read_kafka(spark, servers, EVENTS_TOPIC, **options)
    updates, malformed = updates_of(messages, window_seconds, time_mode, watermark)
    writers = [
        write_kafka(updates, servers, f"{checkpoint}/updates", UPDATES_TOPIC),
        write_message_files(malformed, f"{checkpoint}/malformed-messages", f"{checkpoint}/malformed"),
    ]
    return [writer.trigger(processingTime=trigger).start() for writer in writers]


def run_in_ranges(
    spark: SparkSession,
    servers: str,
    window_seconds: int,
    checkpoint: str,
    trigger: str = "1 minute",
    **options: str,
) -> list[StreamingQuery]:
    """The same, with every batch cut into ranges; time is event time.

    The topic is read once, by one query. Further options go to the source.
    """
    window_seconds = check_window(window_seconds)
    messages = read_kafka(spark, servers, EVENTS_TOPIC, **options)

    def publish(updates: DataFrame) -> None:
        messages = encode_updates(updates).select("key", "value")
        sink = messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
        sink.option("topic", UPDATES_TOPIC).save()

    writer = track_messages(messages, window_seconds, f"{checkpoint}/ranges", publish)
    return [writer.trigger(processingTime=trigger).start()]


def run_live_map(
    spark: SparkSession, servers: str, folder: str, trigger: str = "500 milliseconds", **options: str
) -> StreamingQuery:
    """Keep each city's latest count and change and the largest count in a folder.

    Updates go by their place in the topic; further options go to the source.
    """
    updates = parse_updates(read_kafka(spark, servers, UPDATES_TOPIC, **options))
    return keep_live(updates, folder).trigger(processingTime=trigger).start()


def enriched_updates(messages: DataFrame, cities: DataFrame) -> DataFrame:
    """Update messages with their city's columns; those that don't parse are skipped."""
    return enrich_updates(parse_updates(messages), cities)


def run_consumer(
    spark: SparkSession,
    servers: str,
    cities_path: str,
    folder: str,
    trigger: str = "500 milliseconds",
    **options: str,
) -> StreamingQuery:
    """Start the consumer: updates of the topic with their large city, as JSON lines.

    Further options go to the source. Cities are read once, when it starts.
    """
    cities = settle(large_cities(read_city_features(spark, cities_path)))
    enriched = enriched_updates(read_kafka(spark, servers, UPDATES_TOPIC, **options), cities)
    writer = write_message_files(enriched, f"{folder}/enriched", f"{folder}/checkpoint")
    return writer.trigger(processingTime=trigger).start()


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Track arrivals per city.")
    parser.add_argument("window", help="length of the trailing window in seconds")
    parser.add_argument("servers", help="Kafka servers")
    parser.add_argument("checkpoint", help="folder of the stream's checkpoint")
    parser.add_argument("--event-time", action="store_true", help="expire by event time")
    parser.add_argument("--watermark", default="1 millisecond", help="disorder to allow for")
    parser.add_argument("--ranges", action="store_true", help="for one dominant city")
    parser.add_argument("--cities", help="start the consumer too, with these city features")
    parser.add_argument("--live", action="store_true", help="keep the live map's state too")
    given = parser.parse_args(arguments)
    window_seconds = check_window(given.window)
    spark = SparkSession.builder.appName("floodplan-tracker").getOrCreate()
    if given.ranges:
        run_in_ranges(spark, given.servers, window_seconds, given.checkpoint)
    else:
        time_mode = EVENT_TIME if given.event_time else PROCESSING_TIME
        run(spark, given.servers, window_seconds, given.checkpoint, time_mode, given.watermark)
    if given.cities:
        run_consumer(spark, given.servers, given.cities, f"{given.checkpoint}/consumer")
    if given.live:
        run_live_map(spark, given.servers, f"{given.checkpoint}/live")
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
