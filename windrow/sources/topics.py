"""Topic messages: the value as text, with the coordinates that give each message its place."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TopicSpec:
    """What to consume. Progress is kept in the query's checkpoint, not in the consumer group;
    the group id is passed on for access control and monitoring."""

    servers: str
    topic: str
    group_id: str | None = None
    starting_offsets: str = "latest"
    ending_offsets: str | None = None  # batch reads only
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None  # lets one hot topic partition be read by several tasks
    fail_on_data_loss: bool = True
    options: dict[str, str] = field(default_factory=dict)
    format: str = "kafka"


def topic_options(spec: TopicSpec, streaming: bool = True) -> dict[str, str]:
    """The connector's option map for `spec`."""
    options = {
        "kafka.bootstrap.servers": spec.servers,
        "subscribe": spec.topic,
        "startingOffsets": spec.starting_offsets,
        "failOnDataLoss": str(spec.fail_on_data_loss).lower(),
    }
    if spec.group_id:
        options["kafka.group.id"] = spec.group_id
    if spec.min_partitions:
        options["minPartitions"] = str(spec.min_partitions)
    if streaming:
        if spec.max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(spec.max_offsets_per_trigger)
    else:
        if spec.starting_offsets == "latest":
            options["startingOffsets"] = "earliest"  # a batch read cannot begin at the end
        if spec.ending_offsets:
            options["endingOffsets"] = spec.ending_offsets
    return {**options, **spec.options}


def decode_messages(records: DataFrame) -> DataFrame:
    """Connector rows to `value STRING, topic, partition, offset, timestamp`."""
    return records.select(
        F.col("value").cast("string").alias("value"), "topic", "partition", "offset", "timestamp"
    )


def raw_messages(spark: SparkSession, spec: TopicSpec, *, streaming: bool = True) -> DataFrame:
    """The messages of a topic. Needs the connector package of `spec.format` on the class path."""
    reader = spark.readStream if streaming else spark.read
    return decode_messages(reader.format(spec.format).options(**topic_options(spec, streaming)).load())
