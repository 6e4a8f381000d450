"""Decoded topics into the lake, one query per topic."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cadenza.schemas import EVENT_SCHEMAS, TOPICS
from cadenza.session import prepare
from cadenza.streaming.decode import decode
from cadenza.streaming.kafka import STARTING, read_topic

TRIGGER = "10 seconds"
PARTITIONS = ["year", "month", "day"]


def write_topic(
    events: DataFrame,
    topic: str,
    lake_dir: str,
    checkpoint_dir: str,
    fmt: str = "parquet",
    trigger: str | None = TRIGGER,
) -> StreamingQuery:
    """Append to daily folders. ``trigger=None`` takes all that is there and ends. Longer
    triggers make fewer, larger files."""
    when = {"processingTime": trigger} if trigger else {"availableNow": True}
    return (
        events.writeStream.format(fmt)
        .partitionBy(*PARTITIONS)
        .outputMode("append")
        .option("path", f"{lake_dir.rstrip('/')}/{topic}")
        .option("checkpointLocation", f"{checkpoint_dir.rstrip('/')}/{topic}")
        .queryName(topic)
        .trigger(**when)
        .start()
    )


def start_topics(
    spark: SparkSession,
    read: Callable[[str], DataFrame],
    lake_dir: str,
    checkpoint_dir: str,
    topics: Sequence[str] = TOPICS,
    fmt: str = "parquet",
    trigger: str | None = TRIGGER,
) -> list[StreamingQuery]:
    """Independent queries in one session; ``read`` gives the broker rows of a topic."""
    prepare(spark)
    return [
        write_topic(
            decode(read(topic), EVENT_SCHEMAS[topic]), topic, lake_dir, checkpoint_dir, fmt, trigger
        )
        for topic in topics
    ]


def finish(queries: Sequence[StreamingQuery]) -> None:
    """Wait for queries that end by themselves; a failure of one is raised."""
    for query in queries:
        query.awaitTermination()


STATES = "topic string, state string, batches bigint, error string"


def topic_states(queries: Sequence[StreamingQuery]) -> DataFrame:
    """What became of each query: running, ended or failed, its batches, and the error's first line."""
    rows = []
    for query in queries:
        error = query.exception()
        state = "running" if query.isActive else "failed" if error else "ended"
        progress = query.lastProgress
        batches = progress["batchId"] + 1 if progress else 0
        rows.append((query.name, state, batches, str(error).splitlines()[0] if error else None))
    return SparkSession.active().createDataFrame(rows, STATES)


def settle(queries: Sequence[StreamingQuery]) -> DataFrame:
    """Wait for queries that end by themselves. One that fails does not take the others with it; the
    states tell."""
    for query in queries:
        try:
            query.awaitTermination()
        except StreamingQueryException:
            pass  # kept by the query, and part of its state
    return topic_states(queries)


def run_topics(
    spark: SparkSession,
    read: Callable[[str], DataFrame],
    lake_dir: str,
    checkpoint_dir: str,
    **options,
) -> None:
    """Run until any query ends or fails, then stop them all; also on an interrupt."""
    spark.streams.resetTerminated()
    started = start_topics(spark, read, lake_dir, checkpoint_dir, **options)
    try:
        spark.streams.awaitAnyTermination()
    except KeyboardInterrupt:
        pass
    finally:
        for query in started:
            query.stop()


def run_from_kafka(
    spark: SparkSession,
    servers: str,
    lake_dir: str,
    checkpoint_dir: str,
    starting: str = STARTING,
    max_offsets: int | None = None,
    **options,
) -> None:
    def read(topic: str) -> DataFrame:
        return read_topic(spark, servers, topic, starting, max_offsets)

    run_topics(spark, read, lake_dir, checkpoint_dir, **options)
