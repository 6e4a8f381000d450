"""Where the layers are kept - staging as views, the rest as stored tables, the fact incremental.

A table is stored in versions (``versions.py``) under ``<warehouse>/<layer>/<name>``. The fact and the
play table are kept by day. A run of the fact compares fingerprints of (day, bucket of play keys)
with those stored beside the rows (M13): buckets that agree are neither read nor joined, and days
without a change keep their folders.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cadenza.operators import marts
from cadenza.operators.digests import BUCKET, compared, fingerprints
from cadenza.sources import paths, versions
from cadenza.sources.versions import ROWS, Version

FACT_PARTITION = "play_date_key"
DIGESTS = "digests"
#: Buckets of a day's play keys.
FACT_BUCKETS = 256


def table_path(warehouse: str, layer: str, name: str) -> str:
    return f"{warehouse}/{layer}/{name}"


def is_written(spark: SparkSession, path: str) -> bool:
    return bool(versions.numbers(spark, path))


def read_table(spark: SparkSession, warehouse: str, layer: str, name: str) -> DataFrame:
    return versions.read(spark, table_path(warehouse, layer, name))


def materialise(
    df: DataFrame,
    warehouse: str,
    layer: str,
    name: str,
    kind: str = "table",
    day: str | None = None,
    watch: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Register a view, or store a new version of a table (with a folder for each ``day``) and read
    it: the next layer starts from files, which survive the loss of executors, not from a long
    lineage. Aggregates to ``watch`` are taken by the write and kept in the version's notes."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind != "table":
        raise ValueError(f"unknown kind of table: {kind}")
    path = table_path(warehouse, layer, name)
    return versions.read(spark, path, versions.replace(df, path, day, watch))


def watched(spark: SparkSession, warehouse: str, layer: str, name: str) -> dict:
    """What was watched when the newest version of a table was written."""
    found = versions.newest(spark, table_path(warehouse, layer, name))
    return found.notes.get("watched", {}) if found else {}


def _of_bucket(rows: DataFrame) -> DataFrame:
    bucket = F.pmod(F.xxhash64("play_key"), F.lit(FACT_BUCKETS)).cast("int")
    return rows.withColumn(BUCKET, bucket)


def fact_digests(rows: DataFrame) -> DataFrame:
    """Fingerprints of the rows, without their audit, by day and bucket."""
    data = [c for c in rows.columns if c not in marts.AUDIT]
    return fingerprints(_of_bucket(rows), data, [FACT_PARTITION, BUCKET])


def _days(df: DataFrame) -> list[str]:
    """The days of some rows: few, whatever the number of rows."""
    return [str(r[0]) for r in df.select(FACT_PARTITION).distinct().collect()]


class Aside:
    """Rows that several steps of a run read, written beside the table and gone with the run."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.written = spark, path, []

    def __enter__(self) -> Aside:
        return self

    def __call__(self, df: DataFrame) -> DataFrame:
        folders, _ = versions.write_part(df, self.path, "aside")
        self.written += folders.values()
        held = Version(0, {"aside": df.schema}, {"aside": folders})
        return versions.read(self.spark, self.path, held, "aside")

    def __exit__(self, *_) -> None:
        for folder in self.written:
            paths.remove_dir(self.spark, f"{self.path}/aside/{folder}")


def _store_days(
    rows: DataFrame, path: str, base: Version | None, touched: list[str]
) -> Version:
    """A version in which these rows are the touched days; the other days stay as they are."""
    spark, schema = rows.sparkSession, rows.schema
    new, _ = versions.write_part(rows, path, ROWS, FACT_PARTITION)
    here = Version(0, {ROWS: schema}, {ROWS: new})
    prints = fact_digests(versions.read(spark, path, here))
    schemas = {ROWS: schema, DIGESTS: prints.schema}
    parts = {ROWS: new}
    parts[DIGESTS], _ = versions.write_part(prints, path, DIGESTS, FACT_PARTITION)
    if base:
        schemas = base.schemas
        for part, folders in parts.items():
            kept = {d: f for d, f in base.parts[part].items() if d not in touched}
            parts[part] = kept | dict(folders)
    return versions.commit(spark, path, base, schemas, parts)


def store_fact(int_fact: DataFrame, warehouse: str, run_ts: datetime | str) -> DataFrame:
    """M11-M15 on the stored fact: checked source, changed rows only, audit of this run."""
    spark = int_fact.sparkSession
    path = table_path(warehouse, "marts", "fact_song_play")
    marts.reject_bad_identity(int_fact)
    source = marts.default_foreign_keys(int_fact)
    base = versions.newest(spark, path)
    if base is None:
        first = marts.with_audit(source, run_ts)
        return versions.read(spark, path, _store_days(first, path, None, []))

    marts.reject_schema_change(base.schemas[ROWS], marts.with_audit(source, run_ts).schema)
    groups = [FACT_PARTITION, BUCKET]
    with Aside(spark, path) as aside:
        known = versions.read(spark, path, base, DIGESTS)
        unequal = aside(compared(fact_digests(source), known, groups).filter(~F.col("equal")))
        days = _days(unequal)
        if not days:
            return versions.read(spark, path, base)
        stored = versions.read(spark, path, base, days=days)
        # A row that moved to another day is in an unequal bucket of both days.
        new, old = (
            _of_bucket(rows).join(unequal.select(*groups), groups, "left_semi").select(*rows.columns)
            for rows in (source, stored)
        )
        changed = aside(marts.with_audit(marts.changed_rows(new, old), run_ts))
        replaced = old.join(changed.select("play_key"), "play_key", "left_semi")
        touched = _days(changed.select(FACT_PARTITION).unionByName(replaced.select(FACT_PARTITION)))
        if not touched:
            return versions.read(spark, path, base)
        rows = marts.upsert(versions.read(spark, path, base, days=touched), changed)
        stored_now = _store_days(rows, path, base, touched)
    return versions.read(spark, path, stored_now)
