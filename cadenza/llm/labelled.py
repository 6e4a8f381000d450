"""Labelled rows to learn from: a bounded sample, without the held-out documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import remainder, whole_texts


def training_texts(
    documents: DataFrame, labels: DataFrame, label: str, held_out: Column, most: int
) -> DataFrame:
    """doc_id, text, label (0 or 1) of at most ``most`` labelled documents that are not held out,
    those with the smallest hash of their id. A document labelled more than once takes the average
    (a tie counts as 1); missing labels and ids are skipped."""
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label"))
        .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out)
        .groupBy("doc_id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    # At most ``most`` rows of two numbers: a proven bound.
    return whole_texts(documents).join(F.broadcast(marked), "doc_id")


def held_out(modulus: int, value: int) -> Column:
    return remainder(F.col("doc_id"), modulus) == value
