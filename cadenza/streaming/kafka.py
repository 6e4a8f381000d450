"""One Kafka topic as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: where a new query starts.
STARTING = "earliest"


def topic_options(
    servers: str, topic: str, starting: str = STARTING, max_offsets: int | None = None
) -> dict[str, str]:
    """Without ``max_offsets`` a trigger takes all that has arrived."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = STARTING,
    max_offsets: int | None = None,
) -> DataFrame:
    """Needs the Kafka connector on the cluster."""
    options = topic_options(servers, topic, starting, max_offsets)
    return spark.readStream.format("kafka").options(**options).load()
