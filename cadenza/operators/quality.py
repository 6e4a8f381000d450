"""Q1-Q14: data checks. Each returns its violations (no rows: passed); Q12-Q14 return one row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cadenza.functions.clock import seconds_between
from cadenza.operators.digests import BUCKET, compared, fingerprints, in_buckets
from cadenza.operators.marts import (
    AUDIT, FOREIGN_KEYS, LOADER, Dimension, bad_keys, unknown_member,
)


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Q1."""
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Q2: missing values are not compared."""
    return unique_together(df, [column])


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Q3: the unexpected values and how often they occur; a missing value passes."""
    return _counted(df.filter(~F.col(column).isin(*values)), [column])


def relationships(child: DataFrame, fk: str, parent: DataFrame, key: str) -> DataFrame:
    """Q4: foreign keys without a parent row. Counted per key first, so a hot key is one row by the
    time it is joined."""
    used = _counted(child.filter(F.col(fk).isNotNull()), [fk])
    return used.join(parent.select(F.col(key).alias(fk)), fk, "left_anti")


def unique_together(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q5: rows without any of the values are not compared."""
    some = reduce(Column.__or__, [F.col(c).isNotNull() for c in columns])
    return _counted(df.filter(some), columns).filter(F.col("n") > 1)


def _counted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def expression_is_true(df: DataFrame, condition: Column) -> DataFrame:
    """Q6: rows where the condition is false; an unknown outcome passes."""
    return df.filter(~condition)


def valid_time_key(column: str = "play_time_key") -> Column:
    return (F.col(column) == -1) | F.col(column).between(0, 86399)


def bad_durations(fact: DataFrame) -> DataFrame:
    """Q7: end and duration go together, neither is negative, and they agree."""
    start, end = F.col("play_started_at"), F.col("play_ended_at")
    seconds = F.col("listened_seconds")
    wrong = (
        (end.isNull() != seconds.isNull())
        | F.coalesce(end < start, F.lit(False))
        | F.coalesce(seconds < 0, F.lit(False))
        | ~seconds.eqNullSafe(seconds_between(start, end))
    )
    return fact.filter(wrong).select("play_key")


def bad_audit(marts: dict[str, DataFrame], loader: str = LOADER) -> DataFrame:
    """Q8: model and number of rows whose audit columns are missing or disagree."""
    inserted, inserted_by, updated, updated_by = map(F.col, AUDIT)
    wrong = (
        inserted.isNull()
        | ~inserted.eqNullSafe(updated)
        | ~inserted_by.eqNullSafe(F.lit(loader))
        | ~updated_by.eqNullSafe(F.lit(loader))
    )
    found = [
        df.filter(wrong).select(F.lit(name).alias("model_name")) for name, df in marts.items()
    ]
    return _counted(reduce(DataFrame.unionByName, found), ["model_name"])


def _in_unequal(df: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of the buckets that differ. Broadcast: at most BUCKETS numbers."""
    unequal = groups.filter(~F.col("equal")).select(BUCKET)
    return in_buckets(df, df.columns).join(F.broadcast(unequal), BUCKET, "left_semi").drop(BUCKET)


def _by_bucket(left: DataFrame, right: DataFrame) -> DataFrame:
    """Buckets of rows by hash, with the rows of both sides and whether their fingerprints agree."""
    prints = [fingerprints(in_buckets(s, s.columns), s.columns, [BUCKET]) for s in (left, right)]
    return compared(*prints, [BUCKET])


def _surplus(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, by one grouped count."""
    names = left.columns
    sides = left.withColumn("_copies", F.lit(1)).unionByName(
        right.withColumn("_copies", F.lit(-1))
    )
    counted = sides.groupBy(*names).agg(F.sum("_copies").cast("bigint").alias("surplus"))
    return counted.filter(F.col("surplus") != 0)


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with ``surplus`` copies on the left (negative: right).

    EXCEPT ALL both ways. Fingerprints of buckets are compared first, so that of equal tables no row
    is shuffled; rows of buckets that differ are then counted exactly, and a lost duplicate counts.
    """
    right = right.select(*left.columns)
    groups = _by_bucket(left, right)
    return _surplus(_in_unequal(left, groups), _in_unequal(right, groups))


FACT_KEPT = [
    "play_key", "user_id", "session_id", "item_in_session", "play_started_at", "play_ended_at",
    "listened_seconds",
]
DASHBOARD_KEPT = [
    "play_key", "user_id", "song_key", "location_key", "play_started_at", "listened_seconds",
    "updated_time",
]


def fact_not_preserved(int_fact: DataFrame, mart_fact: DataFrame) -> DataFrame:
    """Q9."""
    return difference(int_fact.select(*FACT_KEPT), mart_fact.select(*FACT_KEPT))


def bad_unknown_member(int_dim: DataFrame, mart_dim: DataFrame, dim: Dimension) -> DataFrame:
    """Q10: exactly one Unknown row, right defaults, no reserved key at the source."""
    attributes = [c for c in int_dim.columns if c != dim.key]
    expected = unknown_member(int_dim, dim)
    reserved = F.lit(dim.reserved).cast(int_dim.schema[dim.key].dataType)
    unknown = mart_dim.filter(F.col(dim.key) == reserved)
    count = unknown.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") != 1)
    source = int_dim.filter(F.col(dim.key) == reserved)
    wrong = unknown.select(*attributes).exceptAll(expected.select(*attributes))
    problems = {
        "missing/duplicate Unknown": count,
        "reserved source key": source,
        "wrong defaults": wrong,
    }
    return reduce(
        DataFrame.unionByName,
        [
            df.select(F.lit(f"{dim.name}: {problem}").alias("problem"))
            for problem, df in problems.items()
        ],
    )


def dashboard_not_preserved(mart_fact: DataFrame, song_plays: DataFrame) -> DataFrame:
    """Q11."""
    return difference(mart_fact.select(*DASHBOARD_KEPT), song_plays.select(*DASHBOARD_KEPT))


def schema_differences(source: DataFrame, target: DataFrame) -> dict[str, tuple]:
    """Column: (source type, target type) where they differ; None where a column is absent."""
    old, new = dict(source.dtypes), dict(target.dtypes)
    return {
        n: (old.get(n), new.get(n))
        for n in sorted(old.keys() | new.keys())
        if old.get(n) != new.get(n)
    }


def reconcile_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """Q12: full rows with multiplicity: totals from the fingerprints of buckets, missing and extra
    rows from an exact count within those that differ."""
    differences = schema_differences(source, target)
    names = ", ".join(differences)
    if set(source.columns) <= set(target.columns):
        # Columns of another type meet as text; the type itself is already reported.
        old, new = (
            side.select(
                *[F.col(c).cast("string").alias(c) if c in differences else c
                  for c in source.columns]
            )
            for side in (source, target)
        )
        groups = _by_bucket(old, new)
        # A bucket that one side lacks needs no comparison: all its rows are missing, or extra.
        both = groups.filter((F.col("left_rows") > 0) & (F.col("right_rows") > 0))
        surplus = _surplus(_in_unequal(old, both), _in_unequal(new, both)).agg(
            F.struct(
                F.sum(F.greatest("surplus", F.lit(0))).alias("missing_rows"),
                F.sum(F.greatest(-F.col("surplus"), F.lit(0))).alias("extra_rows"),
            )
        )
        totals = groups.agg(
            F.sum("left_rows").alias("source_rows"),
            F.sum("right_rows").alias("target_rows"),
            F.sum(F.when(F.col("right_rows") == 0, F.col("left_rows"))).alias("_missing"),
            F.sum(F.when(F.col("left_rows") == 0, F.col("right_rows"))).alias("_extra"),
        ).select("*", surplus.scalar().alias("_found"))
        counted = {
            "source_rows": ["source_rows"],
            "target_rows": ["target_rows"],
            "missing_rows": ["_missing", "_found.missing_rows"],
            "extra_rows": ["_extra", "_found.extra_rows"],
        }
        totals = totals.select(
            *[
                reduce(Column.__add__, [F.coalesce(c, F.lit(0)) for c in parts])
                .cast("bigint").alias(name)
                for name, parts in counted.items()
            ]
        )
    else:
        # Rows cannot be compared without the columns: counts only.
        totals = source.agg(F.count(F.lit(1)).alias("source_rows")).select(
            "source_rows",
            target.agg(F.count(F.lit(1))).scalar().alias("target_rows"),
            F.lit(None).cast("bigint").alias("missing_rows"),
            F.lit(None).cast("bigint").alias("extra_rows"),
        )
    same = (
        (F.col("source_rows") == F.col("target_rows"))
        & (F.coalesce("missing_rows", F.lit(1)) == 0)
        & (F.coalesce("extra_rows", F.lit(1)) == 0)
    )
    return totals.select(
        "*", F.lit(names).alias("schema_differences"), (same & F.lit(not names)).alias("passed")
    )


def unmatched_files(inventory: DataFrame, ledger: DataFrame) -> DataFrame:
    """Q13: files that only the lake or only the ledger names: file_path and side."""
    loaded = ledger.filter(F.col("status") == "SUCCESS").select("file_path").distinct()
    there = inventory.select("file_path").distinct()
    not_loaded = there.join(loaded, "file_path", "left_anti").withColumn("side", F.lit("lake"))
    vanished = loaded.join(there, "file_path", "left_anti").withColumn("side", F.lit("ledger"))
    return not_loaded.unionByName(vanished)


def reconcile_files(inventory: DataFrame, ledger: DataFrame) -> DataFrame:
    """Q13: committed files against ledger successes, one row. Sizes are compared where the ledger
    side carries them."""
    loaded = ledger.filter(F.col("status") == "SUCCESS")
    sides = unmatched_files(inventory, ledger).agg(
        F.struct(
            F.count_if(F.col("side") == "lake").alias("lake"),
            F.count_if(F.col("side") == "ledger").alias("ledger"),
        )
    )
    row = inventory.agg(F.count_distinct("file_path").alias("source_files")).select(
        "source_files",
        loaded.agg(F.count_distinct("file_path")).scalar().alias("ledger_files"),
        sides.scalar().alias("_only"),
    ).select(
        "source_files",
        "ledger_files",
        F.col("_only.lake").alias("files_missing_from_ledger"),
        F.col("_only.ledger").alias("ledger_files_absent_from_source"),
    )
    return row.select(
        "*",
        (
            (F.col("files_missing_from_ledger") == 0)
            & (F.col("ledger_files_absent_from_source") == 0)
        ).alias("passed"),
    )


def missing_dimensions(fact: DataFrame) -> DataFrame:
    """Q14: plays, and how many lack each dimension; over the fact before keys are defaulted."""
    names = ["user", "song", "session", "location", "date", "time"]
    return fact.agg(
        F.count(F.lit(1)).alias("play_count"),
        *[
            F.count_if(F.col(c).isNull()).alias(f"missing_{n}")
            for n, c in zip(names, FOREIGN_KEYS, strict=True)
        ],
    )


class CheckFailed(ValueError):
    """A data check found violations."""


def require(checks: dict[str, DataFrame]) -> None:
    """Run violation checks and stop at the first that finds any row."""
    for name, violations in checks.items():
        if not violations.isEmpty():
            raise CheckFailed(name)
