"""Q12 and Q13 over a live topic: lake against landing, rows and files, in one report row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cadenza.operators import quality
from cadenza.sources import lake
from cadenza.sources.landing import landing_table, read_ledger
from cadenza.streaming.sink import PARTITIONS


def committed_rows(spark: SparkSession, topic_dir: str) -> DataFrame:
    """Rows of the committed files with the columns the files hold, not those of folder names."""
    rows = spark.read.option("mergeSchema", "true").parquet(topic_dir)
    return rows.drop(*PARTITIONS)


def audit_topic(spark: SparkSession, lake_dir: str, warehouse: str, topic: str) -> DataFrame:
    """One row. A topic without a commit log and files of another size are errors, as is a lake that
    changes meanwhile: then nothing is concluded."""
    topic_dir = f"{lake_dir}/{topic}"
    before = lake.commit_state(spark, topic_dir)
    files = lake.inventory(spark, topic_dir, topic)
    wrong = lake.wrong_sizes(files, lake.file_lengths(spark, topic_dir)).first()
    if wrong:
        raise ValueError(f"file differs from its commit log: {wrong['file_path']}")
    source = committed_rows(spark, topic_dir)
    rows = quality.reconcile_rows(source, landing_table(spark, warehouse, topic))
    ledger = read_ledger(spark, warehouse).filter(F.col("topic") == topic)
    named = quality.reconcile_files(files, ledger).withColumnRenamed("passed", "files_passed")
    found = {**rows.first().asDict(), **named.first().asDict()}
    found["passed"] = found["passed"] and found.pop("files_passed")
    if lake.commit_state(spark, topic_dir) != before:
        raise ValueError(f"the lake changed while {topic} was audited; run again")
    schema = T.StructType([T.StructField("topic", T.StringType()), *rows.schema, *named.schema])
    kept = T.StructType([f for f in schema if f.name != "files_passed"])
    return spark.createDataFrame([{"topic": topic, **found}], kept)
