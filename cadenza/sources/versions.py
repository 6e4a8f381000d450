"""Stored tables in versions: folders that never change, and one small file that names them.

==================================  ==============================================================
``<table>/<part>/load=<id>/...``    what one run wrote, with a folder for each day if kept by day
``<table>/versions/<number>.json``  a version: its folders of each part, their schemas, and notes
==================================  ==============================================================

A run writes its folders first and the version file last; that file appears whole or not at all and
is never replaced. A run that dies before leaves folders that no version names: nobody sees them,
and no row of the version before is touched. Of two runs that start from the same version one gets
its number, the other is refused (``ConcurrentRun``). A version may keep folders of the one before,
so a change rewrites only the days it touches. Readers of the version before are left in peace until
``KEPT`` versions have followed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType

from cadenza.sources import paths

ROWS = "rows"
#: What rows without a day are kept under.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
#: Versions that stay readable.
KEPT = 2

#: Folders of a part by day, or by day and load ("<day>@<load>"); of a part that is not kept by day,
#: one folder under "".
Folders = Mapping[str, str]


class ConcurrentRun(RuntimeError):
    """Another run has stored a version meanwhile."""


@dataclass(frozen=True)
class Version:
    number: int
    schemas: dict[str, StructType]
    parts: dict[str, Folders]
    notes: dict = field(default_factory=dict)


def _versions(path: str) -> str:
    return f"{path}/versions"


def _file(path: str, number: int) -> str:
    return f"{_versions(path)}/{number:010d}.json"


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The stored versions of a table, oldest first."""
    names = (name for name, _, _ in paths.listing(spark, _versions(path)))
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")


def version(spark: SparkSession, path: str, number: int) -> Version:
    stored = json.loads(paths.read_text(spark, _file(path, number)))
    schemas = {p: StructType.fromJson(s) for p, s in stored["schemas"].items()}
    return Version(number, schemas, stored["parts"], stored["notes"])


def newest(spark: SparkSession, path: str) -> Version | None:
    found = numbers(spark, path)
    return version(spark, path, found[-1]) if found else None


def read(
    spark: SparkSession,
    path: str,
    of: Version | None = None,
    part: str = ROWS,
    days: Collection[str] | None = None,
    where: Callable[[str], bool] | None = None,
) -> DataFrame:
    """A part of a version (default: the newest). ``days``, or ``where`` asked with a folder's key,
    opens only some folders."""
    of = of or newest(spark, path)
    if of is None:
        raise ValueError(f"nothing is stored in {path}")
    schema = of.schemas[part]
    chosen = sorted(
        folder
        for key, folder in of.parts[part].items()
        if (days is None or key.split("@")[0] in days) and (where is None or where(key))
    )
    if not chosen:
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", f"{path}/{part}")
    wide = StructType([*schema.fields]).add("load", "string")
    return reader.schema(wide).parquet(*[f"{path}/{part}/{f}" for f in chosen]).select(*schema.names)


def write_part(
    df: DataFrame, path: str, part: str = ROWS, day: str | None = None,
    watch: Mapping[str, Column] | None = None,
) -> tuple[Folders, dict]:
    """Folders of a new load, and the values of the aggregates to ``watch``, taken by the write.
    Rows of a day come together first, in as many tasks as their bytes ask for, so that a day has
    few files, whatever the number of tasks before."""
    spark, load = df.sparkSession, f"load={uuid.uuid4().hex}"
    if day:
        df = df.hint("rebalance", day)
    seen = Observation() if watch else None
    if seen:
        df = df.observe(seen, *[value.alias(name) for name, value in watch.items()])
    writer = df.write.partitionBy(day) if day else df.write
    writer.parquet(f"{path}/{part}/{load}")
    found = dict(seen.get) if seen else {}
    if not day:
        return {"": load}, found
    names = (n for n in paths.folders(spark, f"{path}/{part}/{load}") if n.startswith(f"{day}="))
    return {n.split("=", 1)[1]: f"{load}/{n}" for n in names}, found


def commit(
    spark: SparkSession,
    path: str,
    base: Version | None,
    schemas: Mapping[str, StructType],
    parts: Mapping[str, Folders],
    notes: dict | None = None,
) -> Version:
    """The version after ``base``: from here on, and not before, readers see it."""
    number = base.number + 1 if base else 1
    new = Version(number, dict(schemas), dict(parts), notes or {})
    text = json.dumps(
        {
            "schemas": {p: s.jsonValue() for p, s in schemas.items()},
            "parts": {p: dict(f) for p, f in parts.items()},
            "notes": new.notes,
        }
    )
    if not paths.put_new(spark, _file(path, number), text):
        raise ConcurrentRun(f"another run stored version {number} of {path}")
    _forget(spark, path)
    return new


def replace(
    df: DataFrame, path: str, day: str | None = None, watch: Mapping[str, Column] | None = None,
    notes: dict | None = None,
) -> Version:
    """A version with these rows alone; what was watched joins its notes."""
    spark = df.sparkSession
    base = newest(spark, path)
    folders, found = write_part(df, path, ROWS, day, watch)
    return commit(
        spark, path, base, {ROWS: df.schema}, {ROWS: folders}, {**(notes or {}), "watched": found}
    )


def _named(of: Version) -> set[str]:
    return {f"{part}/{f}" for part, folders in of.parts.items() for f in folders.values()}


def _forget(spark: SparkSession, path: str) -> None:
    """Delete the folders that only versions beyond the kept ones name, then those versions."""
    found = numbers(spark, path)
    old, kept = found[:-KEPT], found[-KEPT:]
    if not old:
        return
    needed = set().union(*(_named(version(spark, path, n)) for n in kept))
    for n in old:
        for folder in _named(version(spark, path, n)) - needed:
            paths.remove_dir(spark, f"{path}/{folder}")
        paths.remove_dir(spark, _file(path, n))
