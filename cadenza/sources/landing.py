"""Load committed files once each, tracked in a ledger.

=============================================  ====================================================
``landing/<topic>/load=<id>/``                 rows of a load
``landing/ingestion_ledger/load=<id>/``        its files
``landing/commits/<topic>/<number>.json``      its commit, written last: number, load, rows, schema
=============================================  ====================================================

Rows and ledger of a load become visible together, by its commit; a load that died before leaves
folders that nothing names. A commit's number is the topic's last one plus one and is given once: of
two runs that load the same files at the same time one commits, the other finds the number taken,
drops what it read and looks again for what is still new.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from cadenza.schemas import EVENT_SCHEMAS, LEDGER_SCHEMA, TOPICS
from cadenza.sources import lake, paths

SUCCESS = "SUCCESS"
MAX_FILES_PER_LOAD = 10_000

_COMMIT = "topic string, number bigint, load string, rows bigint"
_STORED = "file_path string, topic string, status string, ingested_at timestamp, load string"


def _ledger_dir(warehouse: str) -> str:
    return f"{warehouse}/landing/ingestion_ledger"


def _topic_dir(warehouse: str, topic: str) -> str:
    return f"{warehouse}/landing/{topic}"


def _commit_file(warehouse: str, topic: str, number: int) -> str:
    return f"{warehouse}/landing/commits/{topic}/{number:010d}.json"


def read_commits(spark: SparkSession, warehouse: str) -> DataFrame:
    """The loads that count. A commit that cannot be read is an error: to pass it over would load
    its files again."""
    folder = f"{warehouse}/landing/commits"
    if not paths.is_dir(spark, folder):
        return spark.createDataFrame([], _COMMIT)
    reader = spark.read.schema(_COMMIT).option("mode", "FAILFAST")
    return reader.option("recursiveFileLookup", "true").json(folder)


def last_load(spark: SparkSession, warehouse: str, topic: str) -> int:
    """Number of the topic's last commit; 0 before the first."""
    names = (n for n, _, _ in paths.listing(spark, f"{warehouse}/landing/commits/{topic}"))
    return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)


def read_ledger(spark: SparkSession, warehouse: str) -> DataFrame:
    """The files of the committed loads; empty if there is none yet. A load is a batch of its
    topic, so its number stands in ``batch_id`` and ``load_id``."""
    if not paths.is_dir(spark, _ledger_dir(warehouse)):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    files = spark.read.schema(_STORED).parquet(_ledger_dir(warehouse))
    commits = read_commits(spark, warehouse).select("load", "number")
    number = F.col("number")
    return files.join(commits, "load").select(
        "file_path", "topic", number.alias("batch_id"), "status", "ingested_at",
        number.alias("load_id"),
    )


def loaded_paths(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("status") == SUCCESS).select("file_path").distinct()


def landing_table(
    spark: SparkSession, warehouse: str, topic: str, after: int = 0
) -> DataFrame:
    """The rows of the committed loads (those numbered over ``after``); before the first load,
    none of the schema that the sink writes."""
    schema = stored_schema(spark, warehouse, topic)
    if schema is None:
        return spark.createDataFrame([], wire_schema(topic))
    loads = read_commits(spark, warehouse).filter(
        (F.col("topic") == topic) & (F.col("number") > after)
    ).select("load")
    rows = spark.read.schema(T.StructType([*schema.fields]).add("load", "string"))
    rows = rows.parquet(_topic_dir(warehouse, topic))
    if after:
        # The new loads' folders are named, so that no other is opened; a run brings few.
        rows = rows.filter(F.col("load").isin([r[0] for r in loads.collect()]))
    else:
        rows = rows.join(loads, "load", "left_semi")
    return rows.drop("load")


def wire_schema(topic: str) -> T.StructType:
    """What the sink writes for a topic; folder names (year=, month=, day=) are not columns."""
    schema = T.StructType()
    for name, kind in (
        ("topic", "string"), ("partition", "integer"), ("offset", "long"),
        ("kafka_timestamp", "timestamp"), ("raw_json", "string"),
    ):
        schema.add(name, kind)
    for field in EVENT_SCHEMAS[topic]:
        schema.add(field.name, "timestamp" if field.name == "ts" else field.dataType)
    return schema.add("hour", "integer")


def stored_schema(spark: SparkSession, warehouse: str, topic: str) -> T.StructType | None:
    """Columns fixed by the first load of the topic."""
    first = _commit_file(warehouse, topic, 1)
    if not paths.exists(spark, first):
        return None
    return T.StructType.fromJson(json.loads(paths.read_text(spark, first))["schema"])


def by_name(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns matched by name to the table: absent ones are NULL, unknown ones are refused."""
    unknown = sorted(set(rows.columns) - set(schema.fieldNames()))
    if unknown:
        raise ValueError(f"columns not in the landing table: {', '.join(unknown)}")
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def read_files(spark: SparkSession, uris: Sequence[str]) -> DataFrame:
    """Rows as stored in the files; folder names (year=, month=, day=) are not columns."""
    return spark.read.option("mergeSchema", "true").parquet(*uris)


def load_files(
    spark: SparkSession, warehouse: str, topic: str, files: Sequence, number: int | None = None
) -> int | None:
    """One load - rows, then ledger, then the commit. Returns the number of rows, or None if
    another run has committed load ``number`` (by default the next one) meanwhile."""
    if number is None:
        number = last_load(spark, warehouse, topic) + 1
    rows = read_files(spark, [f["uri"] for f in files])
    schema = stored_schema(spark, warehouse, topic)
    if schema is not None:
        rows = by_name(rows, schema)
    load = uuid.uuid4().hex
    target = f"{_topic_dir(warehouse, topic)}/load={load}"
    written = Observation()  # counted by the write itself: nothing is read back
    rows.observe(written, F.count(F.lit(1)).alias("rows")).write.parquet(target)
    write_ledger(spark, warehouse, topic, files, load)
    count = written.get["rows"]
    commit = {"topic": topic, "number": number, "load": load, "rows": count}
    if schema is None:
        commit["schema"] = rows.schema.jsonValue()
    if paths.put_new(spark, _commit_file(warehouse, topic, number), json.dumps(commit)):
        return count
    for folder in (target, f"{_ledger_dir(warehouse)}/load={load}"):
        paths.remove_dir(spark, folder)
    return None


def write_ledger(
    spark: SparkSession, warehouse: str, topic: str, files: Sequence, load: str
) -> None:
    at = datetime.now(timezone.utc)
    entries = [(f["file_path"], topic, SUCCESS, at) for f in files]
    ledger = spark.createDataFrame(entries, _STORED.rsplit(",", 1)[0])
    ledger.coalesce(1).write.parquet(f"{_ledger_dir(warehouse)}/load={load}")


def pending_files(
    spark: SparkSession, lake_dir: str, warehouse: str, topics: Sequence[str]
) -> DataFrame:
    """Committed files of these topics that no committed load has."""
    committed = reduce(
        DataFrame.unionByName,
        [lake.committed_files(spark, f"{lake_dir}/{topic}", topic) for topic in topics],
    )
    return lake.new_files(committed, loaded_paths(read_ledger(spark, warehouse)))


def run_ingestion(
    spark: SparkSession,
    lake_dir: str,
    warehouse: str,
    topics: str | Sequence[str] | None = None,
    max_files: int = MAX_FILES_PER_LOAD,
) -> dict[str, int]:
    """Load everything new of all topics, one or some. What is new is asked once for all topics;
    their loads run side by side. A large backlog is taken in several loads, so the file names held
    by the driver stay few; a second run finds nothing."""
    chosen = [topics] if isinstance(topics, str) else list(topics or TOPICS)
    loaded: dict[str, int] = {}
    while chosen:
        # The numbers come first: files that another run commits after this are looked at again.
        numbers = {t: last_load(spark, warehouse, t) + 1 for t in chosen}
        pending = pending_files(spark, lake_dir, warehouse, chosen)
        first = reduce(
            DataFrame.unionByName,
            [
                pending.filter(F.col("topic") == t).orderBy("modified", "file_path").limit(max_files)
                for t in chosen
            ],
        ) if len(chosen) > 1 else pending.orderBy("modified", "file_path").limit(max_files)
        files: dict[str, list] = {}
        for row in first.collect():  # at most max_files a topic
            files.setdefault(row["topic"], []).append(row)
        if not files:
            break
        with ThreadPoolExecutor(len(files)) as pool:
            found = dict(
                zip(
                    files,
                    pool.map(
                        lambda t: load_files(spark, warehouse, t, files[t], numbers[t]), files
                    ),
                )
            )
        for topic, rows in found.items():
            if rows is not None:
                loaded[topic] = loaded.get(topic, 0) + rows
        chosen = [t for t in files if found[t] is None or len(files[t]) == max_files]
    return loaded
