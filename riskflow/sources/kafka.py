"""Kafka as a streaming source. Credentials come from the caller, never from code."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Column layout of the connector, for sources that stand in for a topic.
KAFKA_LAYOUT = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int"
)


def kafka_options(
    servers: str,
    topic: str,
    group: str | None = None,
    starting_offsets: str = "earliest",
    sasl: Mapping[str, str] | None = None,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Source options. ``sasl`` holds ``jaas_config`` and, if not SCRAM-SHA-256, ``mechanism``."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if group:
        options["kafka.group.id"] = group
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if sasl:
        options["kafka.security.protocol"] = "SASL_SSL"
        options["kafka.sasl.mechanism"] = sasl.get("mechanism", "SCRAM-SHA-256")
        options["kafka.sasl.jaas.config"] = sasl["jaas_config"]
    return options


def read_kafka_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Needs the connector on the class path."""
    return spark.readStream.format("kafka").options(**options).load()
