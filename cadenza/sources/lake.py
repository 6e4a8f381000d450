"""Which files of the lake are committed, as Spark itself reads them.

A folder written by the file sink is read through its commit log: files of a batch that never ended
are not there, compacted or not. What a file is called, its committed size and its rows come from
the hidden column ``_metadata``; no data column is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cadenza.sources.paths import is_dir, listing

LOG_DIR = "_spark_metadata"
_FILES = "topic string, file_path string, uri string, size bigint, modified timestamp, rows bigint"


def plain_path(uri: Column) -> Column:
    """The path of a file URI, with one leading slash."""
    path = F.regexp_replace(uri, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return F.regexp_replace(path, "^/*", "/")


def _decoded(uri: Column) -> Column:
    return F.try_url_decode(F.regexp_replace(uri, r"\+", "%2B"))


def commit_state(spark: SparkSession, topic_dir: str) -> list[tuple[str, int, int]]:
    """Names, lengths and times of the commit logs: unequal if the lake has moved meanwhile."""
    return listing(spark, f"{topic_dir}/{LOG_DIR}")


def committed_files(spark: SparkSession, topic_dir: str, topic: str) -> DataFrame:
    """The committed files of a topic with size and rows; no rows if there is no such folder."""
    if not is_dir(spark, topic_dir):
        return spark.createDataFrame([], _FILES)
    uri = _decoded(F.col("_metadata.file_path"))
    files = spark.read.schema("offset bigint").parquet(topic_dir).select(
        uri.alias("uri"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )
    return files.groupBy("uri", "size", "modified").agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(topic).alias("topic"), plain_path(F.col("uri")).alias("file_path"), "uri", "size",
        "modified", "rows",
    )


def new_files(committed: DataFrame, loaded: DataFrame) -> DataFrame:
    """Committed files whose path is not yet loaded."""
    return committed.join(loaded.select("file_path"), "file_path", "left_anti").select(
        *committed.columns
    )


def inventory(spark: SparkSession, topic_dir: str, topic: str) -> DataFrame:
    """The committed files of a live topic, refused if the folder has no commit log or the log
    names no file."""
    if not commit_state(spark, topic_dir):
        raise ValueError(f"no commit log in {topic}")
    files = committed_files(spark, topic_dir, topic)
    if files.isEmpty():
        raise ValueError(f"no committed files in {topic}")
    return files


def file_lengths(spark: SparkSession, topic_dir: str) -> DataFrame:
    """Paths and lengths as they are in the folders now; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(f"{topic_dir}/*=*")
    )
    return files.select(plain_path(_decoded(F.col("path"))).alias("file_path"), "length")


def wrong_sizes(files: DataFrame, lengths: DataFrame) -> DataFrame:
    """Committed files that are gone or have another length than was committed."""
    found = files.join(lengths, "file_path", "left")
    return found.filter(F.col("length").isNull() | (F.col("length") != F.col("size")))
