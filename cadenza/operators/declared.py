"""Q1-Q6 as declarations: what must hold for each table, and two ways to check all of it at once.

Checks of single rows (missing values, accepted values, expressions) are aggregates; a table's own are
taken together by the write that stores it, without a scan of their own (``row_checks``). Checks of
keys (uniqueness, references) of a whole layer are one grouped count (``key_checks``): each table is
read once, gives a row for each of its keys, and counts are merged before they move.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cadenza.operators.marts import AUDIT, LOADER
from cadenza.operators.quality import CheckFailed

NOT_NULL, ACCEPTED, EXPRESSION = "not_null", "accepted_values", "expression_is_true"
UNIQUE, REFERENCE = "unique", "relationships"
REPORT = "name string, violations bigint, example string"


@dataclass(frozen=True)
class Check:
    table: str
    kind: str
    columns: tuple[str, ...]
    #: Accepted values, or the table and key that is referred to, or the SQL of an expression.
    what: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.table}.{'+'.join(self.columns)} {self.kind}"


def _checks(
    table: str,
    not_null: str = "",
    unique: Iterable[str] = (),
    accepted: Mapping[str, tuple] | None = None,
    refers: Mapping[str, tuple[str, str]] | None = None,
    holds: Mapping[str, str] | None = None,
) -> list[Check]:
    return [
        *(Check(table, NOT_NULL, (c,)) for c in not_null.split()),
        *(Check(table, UNIQUE, tuple(u.split())) for u in unique),
        *(Check(table, ACCEPTED, (c,), tuple(v)) for c, v in (accepted or {}).items()),
        *(Check(table, REFERENCE, (c,), to) for c, to in (refers or {}).items()),
        *(Check(table, EXPRESSION, (c,), (sql,)) for c, sql in (holds or {}).items()),
    ]


# Columns, values and references that each layer promises.
_LOCATION = "location_city location_zip location_state location_lon location_lat"
_SONG = "song_artist_name song_name song_duration_seconds"
_DATE = (
    "day_of_week day_name day_of_month day_of_year week_of_year iso_year_number month_number "
    "month_name quarter_number year_number is_weekend"
)
_TIME = (
    "time_value hour_number minute_number second_number hour_12 am_pm minute_of_day second_of_day "
    "time_period"
)
_DIMENSIONS = {
    "user_key": ("dim_user", "user_key"),
    "song_key": ("dim_song", "song_key"),
    "session_key": ("dim_session", "session_key"),
    "location_key": ("dim_location", "location_key"),
    "play_date_key": ("dim_date", "date_key"),
    "play_time_key": ("dim_time", "time_key"),
}
_BY = {c: (LOADER,) for c in AUDIT if c.endswith("_by")}

INTERMEDIATE = [
    *_checks(
        "int_dim_user",
        "user_key user_id start_time end_time is_active",
        ["user_key", "user_id start_time"],
        {"is_active": (True, False)},
    ),
    *_checks(
        "int_dim_session",
        "session_key user_id session_id session_started_time session_number",
        ["session_key", "user_id session_id session_started_time"],
    ),
    *_checks("int_dim_song", f"song_key {_SONG}", ["song_key", _SONG]),
    *_checks("int_dim_location", f"location_key {_LOCATION}", ["location_key", _LOCATION]),
    *_checks("int_dim_date", f"date_key {_DATE}", ["date_key"]),
    *_checks(
        "int_dim_time",
        f"time_key {_TIME}",
        ["time_key"],
        {"am_pm": ("AM", "PM"), "time_period": ("Night", "Morning", "Afternoon", "Evening")},
    ),
    *_checks(
        "int_fact_song_play",
        "play_key user_id session_id item_in_session play_started_at",
        ["play_key", "user_id session_id item_in_session"],
        refers={fk: (f"int_{table}", key) for fk, (table, key) in _DIMENSIONS.items()},
    ),
]
_AUDITED = " ".join(AUDIT)
MARTS = [
    *_checks(
        "dim_user",
        "user_key user_id user_last_name user_first_name user_gender registered_at user_agent "
        f"start_time end_time is_active {_AUDITED}",
        ["user_key"],
        _BY,
    ),
    *_checks("dim_song", f"song_key {_SONG} {_AUDITED}", ["song_key"], _BY),
    *_checks(
        "dim_session",
        f"session_key session_id user_id session_started_time session_number {_AUDITED}",
        ["session_key"],
        _BY,
    ),
    *_checks("dim_location", f"location_key {_LOCATION} {_AUDITED}", ["location_key"], _BY),
    *_checks("dim_date", f"date_key {_DATE} {_AUDITED}", ["date_key"], _BY),
    *_checks(
        "dim_time",
        f"time_key {_TIME} {_AUDITED}",
        ["time_key"],
        _BY,
        holds={"time_key": "time_key = -1 OR time_key BETWEEN 0 AND 86399"},
    ),
    *_checks(
        "fact_song_play",
        f"play_key {' '.join(_DIMENSIONS)} {_AUDITED}",
        ["play_key"],
        _BY,
        refers=_DIMENSIONS,
    ),
]
DASHBOARD = [
    *_checks(
        "song_plays",
        "play_key song_key location_key state gender song artist updated_time",
        ["play_key"],
        {"weekday": tuple(range(1, 8)), "hour": tuple(range(24))},
    ),
    *_checks(
        "filter_options",
        "filter_name filter_value",
        accepted={"filter_name": ("states", "genders")},
    ),
]


def _violated(check: Check) -> Column:
    column = F.col(check.columns[0])
    if check.kind == NOT_NULL:
        return column.isNull()
    if check.kind == ACCEPTED:
        return ~column.isin(*check.what)
    return ~F.expr(check.what[0])


def row_checks(checks: Iterable[Check], table: str) -> dict[str, Column]:
    """Rows that violate each check of single rows: aggregates over the table, by name. An unknown
    outcome passes."""
    return {
        c.name: F.count_if(_violated(c))
        for c in checks
        if c.table == table and c.kind in (NOT_NULL, ACCEPTED, EXPRESSION)
    }


def _key(columns: Iterable[str]) -> Column:
    return F.array(*[F.col(c).cast("string") for c in columns])


def key_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """For each check of keys: how many keys repeat or have no row to refer to, and the first of
    them. Keys without any value are not compared."""
    checks = [c for c in checks if c.kind in (UNIQUE, REFERENCE)]
    roles: dict[str, list[Column]] = {}
    for number, check in enumerate(checks):
        used = F.struct(
            F.lit(number).alias("number"), _key(check.columns).alias("key"),
            F.lit(1).alias("used"), F.lit(0).alias("there"),
        )
        roles.setdefault(check.table, []).append(used)
        if check.kind == REFERENCE:
            parent, key = check.what
            there = F.struct(
                F.lit(number).alias("number"), _key([key]).alias("key"),
                F.lit(0).alias("used"), F.lit(1).alias("there"),
            )
            roles.setdefault(parent, []).append(there)
    keys = [
        tables[name].select(F.explode(F.array(*found)).alias("k")).select("k.*")
        for name, found in roles.items()
    ]
    counted = (
        reduce(DataFrame.unionByName, keys)
        .filter(F.exists("key", lambda v: v.isNotNull()))
        .groupBy("number", "key")
        .agg(F.sum("used").alias("used"), F.max("there").alias("there"))
    )
    numbers = {kind: [n for n, c in enumerate(checks) if c.kind == kind] for kind in (UNIQUE, REFERENCE)}
    repeated = F.col("number").isin(*numbers[UNIQUE]) & (F.col("used") > 1)
    orphaned = F.col("number").isin(*numbers[REFERENCE]) & (F.col("used") > 0) & (F.col("there") == 0)
    bad = repeated | orphaned
    example = F.min(F.when(bad, F.array_join("key", ", ", "NULL")))
    found = counted.groupBy("number").agg(
        F.count_if(bad).alias("violations"), example.alias("example")
    )
    spark = counted.sparkSession
    names = spark.createDataFrame(
        [(n, c.name) for n, c in enumerate(checks)], "number int, name string"
    )
    return names.join(F.broadcast(found), "number", "left").select(
        "name", F.coalesce("violations", F.lit(0)).alias("violations"), "example"
    )


def watched_checks(spark: SparkSession, watched: Mapping[str, int]) -> DataFrame:
    """The report rows of checks that a write has counted."""
    return spark.createDataFrame([(n, int(v), None) for n, v in watched.items()], REPORT)


def scanned_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """The report rows of checks of single rows, by one aggregate over each table."""
    checks, found = list(checks), []
    for name, df in tables.items():
        aggregates = row_checks(checks, name)
        if aggregates:
            rows = [
                F.struct(F.lit(n).alias("name"), v.alias("violations")) for n, v in aggregates.items()
            ]
            found.append(df.agg(F.array(*rows).alias("r")).select(F.inline("r")))
    return reduce(DataFrame.unionByName, found).withColumn("example", F.lit(None).cast("string"))


def report(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """Every declared check with its violations: name, violations, example."""
    checks = list(checks)
    return scanned_checks(tables, checks).unionByName(key_checks(tables, checks))


def enforce(found: DataFrame, tolerate: Collection[str] = ()) -> list[str]:
    """Stop at violated checks, all named at once; those in ``tolerate`` are returned instead."""
    violated = found.filter(F.col("violations") > 0).orderBy("name").collect()  # a row for a check
    stopping = [r for r in violated if r["name"] not in tolerate]
    if stopping:
        raise CheckFailed("; ".join(f"{r['name']}: {r['violations']}" for r in stopping))
    return [r["name"] for r in violated]
