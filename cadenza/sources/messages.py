"""JSON lines as keyed messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("pathGlobFilter", "*.jsonl").text(folder)


def keyed_messages(lines: DataFrame) -> DataFrame:
    """Blank and malformed lines are passed over. The key is the user id as text, empty if missing,
    so that one user's messages share a partition; the value is the record."""
    record = F.trim("value")
    parsed = lines.select(record.alias("value")).filter(
        (F.col("value") != "") & F.try_parse_json("value").isNotNull()
    )
    user = F.get_json_object("value", "$.userId")
    return parsed.select(F.coalesce(user, F.lit("")).alias("key"), "value")


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    """Needs the Kafka connector on the cluster."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic
    ).save()
