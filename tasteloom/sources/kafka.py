"""Kafka endpoints. The connector comes from the caller's session (``spark.jars.packages``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Delivery and rate settings of the rating event topic.
TOPIC = "user-ratings"
READ_DEFAULTS = {"startingOffsets": "earliest"}
# The pace and the loss policy of a small deployment: 5,000 events per trigger, expired offsets skipped
# without a word. To be asked for by name, as neither suits a stream that must keep up and lose nothing.
SMALL_DEPLOYMENT = {"maxOffsetsPerTrigger": "5000", "failOnDataLoss": "false"}
WRITE_DEFAULTS = {
    "kafka.acks": "all",
    "kafka.retries": "5",
    "kafka.linger.ms": "10",
    "kafka.batch.size": "16384",
    "kafka.buffer.memory": "33554432",
    "kafka.request.timeout.ms": "30000",
    "kafka.max.block.ms": "60000",
}


def read_options(servers: str, topic: str = TOPIC, **overrides: str) -> dict[str, str]:
    """Options of the source: all offsets there are per trigger, and an error where offsets have expired,
    unless overridden."""
    return READ_DEFAULTS | {"kafka.bootstrap.servers": servers, "subscribe": topic} | overrides


def write_options(servers: str, topic: str = TOPIC, **overrides: str) -> dict[str, str]:
    return WRITE_DEFAULTS | {"kafka.bootstrap.servers": servers, "topic": topic} | overrides


def read_topic(spark: SparkSession, servers: str, topic: str = TOPIC, **overrides: str) -> DataFrame:
    """Unbounded frame of Kafka records; only ``value`` is used downstream."""
    return spark.readStream.format("kafka").options(**read_options(servers, topic, **overrides)).load()


def write_topic(messages: DataFrame, servers: str, topic: str = TOPIC, **overrides: str) -> None:
    """Send a frame with a ``value`` column to a topic from all its partitions at once."""
    options = write_options(servers, topic, **overrides)
    messages.select("value").write.format("kafka").options(**options).save()
