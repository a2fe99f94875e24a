"""Topic sink. Needs the public Kafka package of Spark on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

# Producer settings of the collector.
PRODUCER_SETTINGS = {
    "batch.size": "65536",
    "linger.ms": "10",
    "compression.type": "lz4",
    "enable.idempotence": "true",
    "acks": "all",
}


def write_options(servers: str, topic: str, **settings: str) -> dict[str, str]:
    """Options of the Kafka sink; `settings` override single producer settings by their own names."""
    producer = {**PRODUCER_SETTINGS, **{k.replace("_", "."): v for k, v in settings.items()}}
    return {
        "kafka.bootstrap.servers": servers, "topic": topic,
        **{f"kafka.{name}": value for name, value in producer.items()},
    }


def write_topic(payloads: DataFrame, servers: str, topic: str, **settings: str) -> None:
    """Send a table with `value` (and `key`, if there is one); at least once."""
    payloads.write.format("kafka").options(**write_options(servers, topic, **settings)).save()


def topic_writer(payloads: DataFrame, servers: str, topic: str, checkpoint: str, **settings: str) -> DataStreamWriter:
    """The same for a stream."""
    options = write_options(servers, topic, **settings)
    return payloads.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint)
