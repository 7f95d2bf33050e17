"""The sensor-event stream: one JSON message per facility and cycle."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallywater.schemas import EVENT_FIELDS, EVENT_SCHEMA

# Stream settings; KAFKA_TOPIC and KAFKA_BOOTSTRAP_SERVERS override the first two.
TOPIC = "sensor_events"
SERVERS = "localhost:9092"
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.max.in.flight.requests.per.connection": "1",
}


def kafka_options(servers: str | None = None) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers or os.environ.get("KAFKA_BOOTSTRAP_SERVERS", SERVERS)
    }


def topic_name(topic: str | None = None) -> str:
    return topic or os.environ.get("KAFKA_TOPIC", TOPIC)


def read_kafka(
    spark: SparkSession, topic: str | None = None, servers: str | None = None, **options: str
) -> DataFrame:
    """Raw messages of the topic as a stream with a ``value`` string (needs the Kafka package)."""
    reader = spark.readStream.format("kafka").option("subscribe", topic_name(topic))
    for key, setting in {**kafka_options(servers), "failOnDataLoss": "true", **options}.items():
        reader = reader.option(key, setting)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def read_json_files(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """The same stream from a folder of JSON-lines files, one message per line."""
    return (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
        .select("value")
    )


def parse_messages(raw: DataFrame) -> DataFrame:
    """Messages with the parsed ``event`` (null fields where malformed) and a ``valid`` flag."""
    event = F.from_json("value", EVENT_SCHEMA, {"mode": "PERMISSIVE"})
    parsed = raw.withColumn("event", event)
    needed = F.col("event.event_id").isNotNull() & F.col("event.timestamp").isNotNull()
    return parsed.withColumn("valid", F.coalesce(needed, F.lit(False)))


def valid_events(parsed: DataFrame) -> DataFrame:
    return parsed.where("valid").select("event.*")


def malformed_messages(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("valid")).select("value")


def to_messages(events: DataFrame) -> DataFrame:
    """Events as Kafka ``key``/``value`` rows; the facility name keeps its events in order."""
    return events.select(
        F.col("facility.name").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in EVENT_FIELDS])).alias("value"),
    )


def write_kafka(
    messages: DataFrame, checkpoint: str, topic: str | None = None, servers: str | None = None
):
    """Start sending ``key``/``value`` rows to the topic (needs the Kafka package)."""
    writer = messages.writeStream.format("kafka").option("topic", topic_name(topic))
    for key, setting in {**kafka_options(servers), **PRODUCER_OPTIONS}.items():
        writer = writer.option(key, setting)
    return writer.option("checkpointLocation", checkpoint).start()
