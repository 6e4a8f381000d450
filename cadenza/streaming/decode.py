"""Broker rows to typed events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

WATERMARK = "30 minutes"


def decode(broker: DataFrame, schema: StructType, watermark: str = WATERMARK) -> DataFrame:
    """Batch or stream. A value that is not JSON gives NULL fields and stays in ``raw_json``; a bad
    field is NULL alone."""
    raw = F.col("value").cast("string")
    parsed = broker.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        raw.alias("raw_json"),
        F.from_json(raw, schema).alias("event"),
    )
    at = F.timestamp_millis(F.col("event.ts"))
    fields = [
        (at if name == "ts" else F.col(f"event.{name}")).alias(name) for name in schema.fieldNames()
    ]
    calendar = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour}
    return parsed.select(
        "topic", "partition", "offset", "kafka_timestamp", "raw_json",
        *fields,
        *[part(at).alias(name) for name, part in calendar.items()],
    ).withWatermark("kafka_timestamp", watermark)
