"""Conformed dimensions with an Unknown member, and the incremental fact."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

LOADER = "cadenza"
AUDIT = ["inserted_time", "inserted_by", "updated_time", "updated_by"]

# What stands for a missing value of each type, and the reserved keys.
EPOCH = "1970-01-01 00:00:00"
MIDNIGHT = "00:00:00"
UNKNOWN = "Unknown"
UNKNOWN_KEY = "-1"
UNKNOWN_DATE = "1970-01-01"
UNKNOWN_TIME_KEY = -1


def default_for(data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        value = UNKNOWN
    elif isinstance(data_type, T.BooleanType):
        value = False
    elif isinstance(data_type, T.DateType):
        value = UNKNOWN_DATE
    elif isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        value = EPOCH
    else:
        value = -1
    return F.lit(value).cast(data_type)


@dataclass(frozen=True)
class Dimension:
    name: str
    key: str
    reserved: str | int = UNKNOWN_KEY
    defaults: dict[str, str] = field(default_factory=dict)

    @property
    def error(self) -> str:
        return f"Invalid or reserved dimension key: {self.name}"


DIM_USER = Dimension("dim_user", "user_key")
DIM_SONG = Dimension("dim_song", "song_key")
DIM_SESSION = Dimension("dim_session", "session_key")
DIM_LOCATION = Dimension("dim_location", "location_key")
DIM_DATE = Dimension("dim_date", "date_key", UNKNOWN_DATE)
DIM_TIME = Dimension("dim_time", "time_key", UNKNOWN_TIME_KEY, {"time_value": MIDNIGHT})
DIMENSIONS = [DIM_USER, DIM_SONG, DIM_SESSION, DIM_LOCATION, DIM_DATE, DIM_TIME]


def distinct_source(int_dim: DataFrame) -> DataFrame:
    """M7: merge exact copies before any default, so that rows which differ only in a missing value
    stay two and the uniqueness check rejects them."""
    return int_dim.distinct()


def bad_keys(int_dim: DataFrame, dim: Dimension) -> DataFrame:
    key = F.col(dim.key)
    reserved = F.lit(dim.reserved).cast(int_dim.schema[dim.key].dataType)
    return int_dim.filter(key.isNull() | (key == reserved))


def reject_bad_keys(int_dim: DataFrame, dim: Dimension) -> None:
    """M8, before anything is written."""
    if not bad_keys(int_dim, dim).isEmpty():
        raise ValueError(dim.error)


def _defaults(schema: T.StructType, dim: Dimension) -> dict[str, Column]:
    return {
        f.name: F.lit(dim.defaults[f.name]) if f.name in dim.defaults else default_for(f.dataType)
        for f in schema
        if f.name != dim.key
    }


def unknown_member(int_dim: DataFrame, dim: Dimension) -> DataFrame:
    values = _defaults(int_dim.schema, dim)
    values[dim.key] = F.lit(dim.reserved).cast(int_dim.schema[dim.key].dataType)
    return int_dim.sparkSession.range(1).select(*[values[c].alias(c) for c in int_dim.columns])


def with_unknown(int_dim: DataFrame, dim: Dimension) -> DataFrame:
    """M9: typed defaults for missing attributes (an empty string stays) plus one Unknown row."""
    key = F.col(dim.key)
    reserved = F.lit(dim.reserved).cast(int_dim.schema[dim.key].dataType)
    bad = key.isNull() | (key == reserved)
    guarded = F.when(bad, F.raise_error(F.lit(dim.error))).otherwise(key)
    values = _defaults(int_dim.schema, dim)
    filled = int_dim.select(
        *[
            guarded.alias(c) if c == dim.key else F.coalesce(F.col(c), values[c]).alias(c)
            for c in int_dim.columns
        ]
    )
    return filled.unionByName(unknown_member(int_dim, dim))


def with_audit(df: DataFrame, run_ts: datetime | str, loader: str = LOADER) -> DataFrame:
    """One run start for the whole run; never the clock of a stage."""
    at = F.lit(str(run_ts)).cast("timestamp")
    by = F.lit(loader)
    return df.select(
        "*", *[v.alias(c) for c, v in zip(AUDIT, (at, by, at, by), strict=True)]
    )


def build_dimension(int_dim: DataFrame, dim: Dimension, run_ts: datetime | str) -> DataFrame:
    return with_audit(with_unknown(distinct_source(int_dim), dim), run_ts)


def dim_user(int_dim: DataFrame, run_ts: datetime | str) -> DataFrame:
    return build_dimension(int_dim, DIM_USER, run_ts)


def dim_song(int_dim: DataFrame, run_ts: datetime | str) -> DataFrame:
    return build_dimension(int_dim, DIM_SONG, run_ts)


def dim_session(int_dim: DataFrame, run_ts: datetime | str) -> DataFrame:
    return build_dimension(int_dim, DIM_SESSION, run_ts)


def dim_location(int_dim: DataFrame, run_ts: datetime | str) -> DataFrame:
    return build_dimension(int_dim, DIM_LOCATION, run_ts)


def dim_date(int_dim: DataFrame, run_ts: datetime | str) -> DataFrame:
    return build_dimension(int_dim, DIM_DATE, run_ts)


def dim_time(int_dim: DataFrame, run_ts: datetime | str) -> DataFrame:
    return build_dimension(int_dim, DIM_TIME, run_ts)


def source_identity(fact: DataFrame, key: str = "play_key") -> DataFrame:
    """Rows against distinct keys, one row. Counting per key first keeps the shuffle partial."""
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    keys = F.count(key)
    rows = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")
    return per_key.agg(rows.alias("row_count"), keys.alias("key_count")).select(
        "*", (F.col("row_count") == F.col("key_count")).alias("is_valid")
    )


def reject_bad_identity(fact: DataFrame, key: str = "play_key") -> None:
    if not source_identity(fact, key).first()["is_valid"]:
        raise ValueError(f"NULL or duplicate source {key}")


FOREIGN_KEYS = {
    "user_key": UNKNOWN_KEY,
    "song_key": UNKNOWN_KEY,
    "session_key": UNKNOWN_KEY,
    "location_key": UNKNOWN_KEY,
    "play_date_key": UNKNOWN_DATE,
    "play_time_key": UNKNOWN_TIME_KEY,
}


def default_foreign_keys(fact: DataFrame) -> DataFrame:
    """The six keys point to Unknown when missing; nothing else is touched."""
    types = {f.name: f.dataType for f in fact.schema}
    return fact.select(
        *[
            F.coalesce(F.col(c), F.lit(FOREIGN_KEYS[c]).cast(types[c])).alias(c)
            if c in FOREIGN_KEYS
            else F.col(c)
            for c in fact.columns
        ]
    )


def changed_rows(source: DataFrame, target: DataFrame, key: str = "play_key") -> DataFrame:
    """Source rows that are new or differ from the target in any column, nulls compared.

    The key is a hash, so the join is spread evenly; both sides travel without audit columns.
    """
    data = F.struct(*[c for c in source.columns if c != key])
    old = target.select(F.col(key), data.alias("_old"))
    joined = source.join(old, key, "left")
    return joined.filter(F.col("_old").isNull() | ~data.eqNullSafe(F.col("_old"))).select(
        *source.columns
    )


def upsert(target: DataFrame, changed: DataFrame, key: str = "play_key") -> DataFrame:
    """Changed rows replace theirs; all others stay as they are, also those gone at source."""
    return target.join(changed.select(key), key, "left_anti").unionByName(changed)


def reject_schema_change(stored: T.StructType, incoming: T.StructType) -> None:
    """Column names and types must stay; nullability and order may differ."""
    old = {f.name: f.dataType for f in stored}
    new = {f.name: f.dataType for f in incoming}
    if old != new:
        names = sorted(n for n in old.keys() | new.keys() if old.get(n) != new.get(n))
        raise ValueError(f"schema of the stored fact differs in: {', '.join(names)}")


def fact_rows(int_fact: DataFrame, run_ts: datetime | str) -> DataFrame:
    """First load: every source row with defaulted keys and this run's audit."""
    return with_audit(default_foreign_keys(int_fact), run_ts)


def fact_song_play(int_fact: DataFrame, stored: DataFrame, run_ts: datetime | str) -> DataFrame:
    """The whole fact after an incremental run."""
    changed = changed_rows(default_foreign_keys(int_fact), stored)
    return upsert(stored, with_audit(changed, run_ts))
