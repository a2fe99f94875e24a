"""Raw topic as a table or a stream. Needs the public Kafka package of Spark on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cinderlog.schema import RAW_TOPIC


def read_options(
    servers: str,
    topic: str = RAW_TOPIC,
    group_id: str | None = None,
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source: one topic, from the earliest offset on a new checkpoint.

    Queries that share a consumer group can each see only part of the data, so each gets its own unless `group_id` is
    given. `min_partitions` splits large topic partitions over more tasks; `max_offsets_per_trigger`
    bounds what one micro-batch takes in.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if group_id is not None:
        options["kafka.group.id"] = group_id
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def message_text(df: DataFrame, *keep: str) -> DataFrame:
    """The message value as text, after the named source columns."""
    return df.select(*keep, F.col("value").cast("string").alias("value"))


def topic_stream(spark: SparkSession, servers: str, **options) -> DataFrame:
    """Unbounded frame of `topic, partition, offset, timestamp, value`."""
    raw = spark.readStream.format("kafka").options(**read_options(servers, **options)).load()
    return message_text(raw, "topic", "partition", "offset", "timestamp")


def topic_table(spark: SparkSession, servers: str, **options) -> DataFrame:
    """The same columns for what the topic holds now."""
    raw = spark.read.format("kafka").options(**read_options(servers, **options)).load()
    return message_text(raw, "topic", "partition", "offset", "timestamp")
