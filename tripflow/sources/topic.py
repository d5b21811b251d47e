"""Message topic source (S2). Needs Spark's Kafka connector on the classpath;
the parse step (:func:`tripflow.operators.feeds.parse_status_messages`)
accepts any frame with a ``value`` column, so files or memory streams can
stand in for the topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_source_options(servers: str, topic: str, starting_offsets: str = "latest",
                         max_offsets_per_trigger: int | None = None,
                         fail_on_data_loss: bool = True) -> dict[str, str]:
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def read_topic(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
               max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> DataFrame:
    """Streaming frame of the topic's records (``key``, ``value`` binary, ...).
    Offsets that are gone stop the query unless ``fail_on_data_loss`` is off."""
    opts = kafka_source_options(servers, topic, starting_offsets, max_offsets_per_trigger, fail_on_data_loss)
    return spark.readStream.format("kafka").options(**opts).load()
