"""T6 and D7-D11 kept up to date: what new loads add to staging and to the user history.

**Staging** keeps two 64-bit hashes as columns of each row, in folders by day and load. An exact copy
has the same time, so new rows are compared with the hashes of their own days only: of the rows
stored, other days are not opened and other columns are not read. A day of more than
``MOST_FOLDERS`` folders is put together again.

**The history** keeps its observations by load, the periods, and for each user the time of the last
observation. A user whose new observations are all later goes on from the open period: its state and
start are one more observation, and earlier periods stay. Only users with a late observation (or one
without a time) are rebuilt from all that was seen of them.

Both are stored in versions: a run that dies is done again by the next, from the same loads.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession, functions as F

from cadenza.operators import history, staging
from cadenza.operators.digests import row_hash
from cadenza.operators.ordered import CHUNK_SECONDS, Width
from cadenza.schemas import EVENT_SCHEMAS, TOPICS
from cadenza.sources import landing, versions
from cadenza.sources.tables import Aside, table_path
from cadenza.sources.versions import ROWS, Folders, Version

MOST_FOLDERS = 64
OBSERVATIONS, LAST, PERIODS = "observations", "last", "periods"

_DAY, _PRINT = "_day", ["_one", "_two"]


def _staged(warehouse: str, topic: str) -> str:
    return table_path(warehouse, "staging", f"stg_{topic}")


def _history(warehouse: str) -> str:
    return table_path(warehouse, "intermediate", "user_history")


def _by_load(folders: Folders, load: int) -> Folders:
    return {f"{day}@{load}": folder for day, folder in folders.items()}


def load_of(key: str) -> int:
    return int(key.rsplit("@", 1)[1])


def staged_load(spark: SparkSession, warehouse: str, topic: str) -> int:
    """Number of the last load that is in staging."""
    base = versions.newest(spark, _staged(warehouse, topic))
    return base.notes["load"] if base else 0


def staged(spark: SparkSession, warehouse: str, topic: str, after: int = 0) -> DataFrame:
    """Staging of a topic; ``after`` leaves out what loads up to that number brought."""
    path = _staged(warehouse, topic)
    base = versions.newest(spark, path)
    if base is None:
        return staging.stage(landing.landing_table(spark, warehouse, topic), topic)
    rows = versions.read(spark, path, base, where=lambda key: load_of(key) > after)
    return rows.select(*EVENT_SCHEMAS[topic].fieldNames())


def _known(spark: SparkSession, path: str, base: Version, days: list[str]) -> DataFrame:
    """Hashes of the rows that staging has of these days."""
    return versions.read(spark, path, base, days=days).select(*_PRINT)


def extend_staging(spark: SparkSession, warehouse: str, topic: str) -> DataFrame:
    """The distinct rows of the new loads join those that staging has."""
    path, last = _staged(warehouse, topic), landing.last_load(spark, warehouse, topic)
    base = versions.newest(spark, path)
    if last == (base.notes["load"] if base else 0):
        return staged(spark, warehouse, topic)
    names = EVENT_SCHEMAS[topic].fieldNames()
    arrived = landing.landing_table(spark, warehouse, topic, base.notes["load"] if base else 0)
    new = staging.stage(arrived, topic).select(
        "*",
        F.to_date("ts").alias(_DAY),
        *[row_hash(names, seed).alias(c) for c, seed in zip(_PRINT, ("", "second"))],
    )
    with Aside(spark, path) as aside:
        if base:
            new = aside(new)
            days = [
                str(r[0]) if r[0] else versions.NO_DAY for r in new.select(_DAY).distinct().collect()
            ]
            new = new.join(_known(spark, path, base, days), _PRINT, "left_anti")
        rows = new.select(*names, *_PRINT, _DAY)
        folders, _ = versions.write_part(rows, path, ROWS, _DAY)
    schemas = {ROWS: rows.schema}
    kept = dict(base.parts[ROWS] if base else {}) | _by_load(folders, last)
    crowded = {day for day, n in Counter(k.split("@")[0] for k in kept).items() if n > MOST_FOLDERS}
    if crowded:
        held = Version(0, schemas, {ROWS: kept})
        together, _ = versions.write_part(
            versions.read(spark, path, held, days=crowded), path, ROWS, _DAY
        )
        kept = {k: f for k, f in kept.items() if k.split("@")[0] not in crowded}
        kept |= _by_load(together, last)
    parts = {ROWS: kept}
    versions.commit(spark, path, base, schemas, parts, {"load": last})
    return staged(spark, warehouse, topic)


def _seen(observations: DataFrame, base: DataFrame | None) -> DataFrame:
    """For each user with new observations: whether the user must be rebuilt, and the new last time."""
    spark, ts = observations.sparkSession, F.col("ts")
    if base is None:
        base = spark.createDataFrame([], "user_id int, last_ts timestamp, untimed boolean")
    before = base.withColumn("known", F.lit(True))
    late = F.col("known").isNotNull() & (
        F.col("untimed") | ts.isNull() | F.col("last_ts").isNull() | (ts <= F.col("last_ts"))
    )
    return observations.join(before, "user_id", "left").groupBy("user_id").agg(
        F.bool_or(late).alias("late"),
        F.greatest(F.max("ts"), F.max("last_ts")).alias("last_ts"),
        (F.bool_or(ts.isNull()) | F.bool_or(F.coalesce("untimed", F.lit(False)))).alias("untimed"),
    )


def extend_history(
    spark: SparkSession, warehouse: str, seconds: Width = CHUNK_SECONDS
) -> DataFrame:
    """The user dimension with the observations of the rows new to staging."""
    path = _history(warehouse)
    base = versions.newest(spark, path)
    done = base.notes["loads"] if base else dict.fromkeys(TOPICS, 0)
    now = {t: staged_load(spark, warehouse, t) for t in TOPICS}
    if base and done == now:
        return versions.read(spark, path, base, PERIODS)
    run = base.number + 1 if base else 1
    with Aside(spark, path) as aside:
        streams = [staged(spark, warehouse, t, after=done[t]) for t in TOPICS]
        new = aside(history.user_observations(*streams))
        users = aside(_seen(new, versions.read(spark, path, base, LAST) if base else None))
        late, on_time = users.filter("late").select("user_id"), users.filter("not late").select("user_id")
        observed = new
        if base:
            periods = versions.read(spark, path, base, PERIODS)
            going_on = periods.filter("is_active").join(on_time, "user_id", "left_semi").select(
                F.col("start_time").alias("ts"), "user_id", *history.USER_ATTRIBUTES
            )
            again = versions.read(spark, path, base, OBSERVATIONS).join(late, "user_id", "left_semi")
            # A late user's new observations may be known already.
            observed = new.unionByName(going_on).unionByName(again.select(*new.columns)).distinct()
        rebuilt = history.keyed_periods(history.effective_periods(observed, seconds=seconds))
        last = users.select("user_id", "last_ts", "untimed")
        if base:
            status = users.select("user_id", "late")
            kept = periods.join(status, "user_id", "left").filter(
                F.col("late").isNull() | (~F.col("late") & ~F.col("is_active"))
            )
            rebuilt = kept.select(*rebuilt.columns).unionByName(rebuilt)
            others = versions.read(spark, path, base, LAST).join(status, "user_id", "left_anti")
            last = last.unionByName(others)
        kinds = {OBSERVATIONS: new, LAST: last, PERIODS: rebuilt}
        parts = {part: versions.write_part(df, path, part)[0] for part, df in kinds.items()}
        parts[OBSERVATIONS] = {
            **(base.parts[OBSERVATIONS] if base else {}), **_by_load(parts[OBSERVATIONS], run)
        }
        schemas = base.schemas if base else {part: df.schema for part, df in kinds.items()}
    stored = versions.commit(spark, path, base, schemas, parts, {"loads": now})
    return versions.read(spark, path, stored, PERIODS)
