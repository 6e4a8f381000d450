"""Attribute history (SCD2) of an entity from its observations.

D8-D11 are generic over the entity column, the time column and the attributes; the user dimension
is their one use. Ties on time are broken by the attributes, missing values last.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cadenza.functions.keys import surrogate_key
from cadenza.operators.ordered import CHUNK, CHUNK_SECONDS, Width, carry, in_chunk, with_chunk

USER_ATTRIBUTES = [
    "user_last_name", "user_first_name", "user_gender", "user_agent", "registered_at",
]
OPEN_END = "9999-12-01 00:00:00"

_NTH, _EDGE, _BEFORE = "_nth", "_edge", "_before"


def user_observations(*streams: DataFrame, seconds: Width | None = None) -> DataFrame:
    """Every distinct sighting of a known user in the given streams. With ``seconds`` the rows
    are dealt by (user, chunk) before copies are removed and keep their chunk, so that the work on
    chunks that follows needs no shuffle of its own."""
    seen = [
        s.filter(F.col("userId").isNotNull()).select(
            "ts",
            F.col("userId").alias("user_id"),
            F.col("lastName").alias("user_last_name"),
            F.col("firstName").alias("user_first_name"),
            F.col("gender").alias("user_gender"),
            F.col("userAgent").alias("user_agent"),
            F.col("registration").alias("registered_at"),
        )
        for s in streams
    ]
    rows = reduce(DataFrame.unionByName, seen)
    if seconds is not None:
        rows = with_chunk(rows, "ts", seconds, "user_id").repartition("user_id", CHUNK)
    return rows.distinct()


def _order(ts: str, attributes: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in (ts, *attributes)]


def _flagged(observations, entity, ts, attributes, seconds) -> DataFrame:
    spec = in_chunk([entity], _order(ts, attributes))
    state = F.struct(*attributes)
    local = with_chunk(observations, ts, seconds, entity).select(
        "*",
        F.row_number().over(spec).alias(_NTH),
        F.lag(state).over(spec).alias(_BEFORE),
        F.lead(F.lit(True)).over(spec).isNull().alias("_last"),
    )
    edges = local.filter("_last").select(entity, CHUNK, state.alias(_EDGE), F.col(_NTH).alias("_n"))
    rows = carry(
        local.drop("_last"),
        edges,
        [entity],
        lambda w: {
            "_carried": F.lag(_EDGE).over(w),
            "_offset": F.coalesce(
                F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        },
    )
    previous = F.when(F.col(_NTH) == 1, F.col("_carried")).otherwise(F.col(_BEFORE))
    numbered = rows.withColumn("_previous", previous).withColumn(
        "observation_number", (F.col(_NTH) + F.col("_offset")).cast("bigint")
    )
    changed = (F.col("observation_number") == 1) | ~state.eqNullSafe(F.col("_previous"))
    return numbered.withColumn("is_new_version", F.when(changed, 1).otherwise(0))


def change_flags(
    observations: DataFrame,
    entity: str = "user_id",
    ts: str = "ts",
    attributes: Sequence[str] = USER_ATTRIBUTES,
    seconds: Width = CHUNK_SECONDS,
) -> DataFrame:
    """Number the observations, show the previous state, flag each change."""
    rows = _flagged(observations, entity, ts, attributes, seconds)
    return rows.select(
        *observations.columns,
        "observation_number",
        *[F.col("_previous")[a].alias(f"previous_{a}") for a in attributes],
        "is_new_version",
    )


def version_numbers(
    observations: DataFrame,
    entity: str = "user_id",
    ts: str = "ts",
    attributes: Sequence[str] = USER_ATTRIBUTES,
    seconds: Width = CHUNK_SECONDS,
) -> DataFrame:
    """Running count of changes; a state that comes back later is a new version."""
    flagged = _flagged(observations, entity, ts, attributes, seconds)
    spec = in_chunk([entity], _order(ts, attributes))
    running = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = flagged.withColumn("_in_chunk", F.sum("is_new_version").over(running))
    edges = local.groupBy(entity, CHUNK).agg(F.sum("is_new_version").alias("_changes"))
    rows = carry(
        local,
        edges,
        [entity],
        lambda w: {
            "_earlier": F.coalesce(
                F.sum("_changes").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            )
        },
    )
    return rows.select(
        *observations.columns,
        "is_new_version",
        (F.col("_in_chunk") + F.col("_earlier")).cast("bigint").alias("version_number"),
    )


def _versions(observations, entity, ts, attributes, seconds) -> DataFrame:
    """Rows that start a version, with the next start of the entity in ``_following``.

    All rows of a version share one state, so its earliest row is the one that differs from the row
    before: no grouping. One pass per chunk, newest first, finds for each row the state before it
    and the next change after it; only the first row of a chunk must ask the chunk before whether
    it is a change, and only what is left without a next change asks the chunks after.
    """
    newest_first = in_chunk(
        [entity], [F.col(c).desc_nulls_first() for c in ("start_time", *attributes)]
    )
    later_rows = newest_first.rowsBetween(Window.unboundedPreceding, -1)
    state = F.struct(*attributes)
    dealt = [CHUNK] if CHUNK in observations.columns else []
    timed = observations.select(entity, *attributes, F.col(ts).alias("start_time"), *dealt)
    if not dealt:
        timed = with_chunk(timed, "start_time", seconds, entity)
    seen = timed.select(
        "*",
        state.alias("_state"),
        F.lead(state).over(newest_first).alias(_BEFORE),
        F.lead(F.lit(True)).over(newest_first).isNull().alias("_opens"),
        F.first(state).over(newest_first).alias("_latest"),
    )
    differs = ~F.col("_opens") & ~F.col("_state").eqNullSafe(F.col(_BEFORE))
    local = seen.withColumn("_differs", differs).withColumn(
        "_next",
        F.last(F.when(F.col("_differs"), F.col("start_time")), ignorenulls=True).over(later_rows),
    )

    chunks = Window.partitionBy(entity).orderBy(F.col(CHUNK).desc())
    later_chunks = chunks.rowsBetween(Window.unboundedPreceding, -1)
    edges = local.filter("_opens").withColumn(
        "_changed", ~F.col("_state").eqNullSafe(F.lead("_latest").over(chunks))
    )
    first_start = F.when(F.col("_changed"), F.col("start_time")).otherwise(F.col("_next"))
    edges = edges.withColumn("_first", first_start).select(
        entity,
        CHUNK,
        "_changed",
        F.last("_first", ignorenulls=True).over(later_chunks).alias("_later"),
    )
    rows = local.filter("_opens or _differs").join(edges, [entity, CHUNK], "left")
    starts = rows.filter(F.when(F.col("_opens"), F.col("_changed")).otherwise(F.col("_differs")))
    return starts.select(
        entity, *attributes, "start_time", F.coalesce("_next", "_later").alias("_following")
    )


def version_starts(
    observations: DataFrame,
    entity: str = "user_id",
    ts: str = "ts",
    attributes: Sequence[str] = USER_ATTRIBUTES,
    seconds: Width = CHUNK_SECONDS,
) -> DataFrame:
    """One row per version with the time it was first seen."""
    return _versions(observations, entity, ts, attributes, seconds).drop("_following")


def effective_periods(
    observations: DataFrame,
    entity: str = "user_id",
    ts: str = "ts",
    attributes: Sequence[str] = USER_ATTRIBUTES,
    seconds: Width = CHUNK_SECONDS,
) -> DataFrame:
    """Half-open periods [start_time, end_time); the last one is open and active."""
    versions = _versions(observations, entity, ts, attributes, seconds)
    following = F.col("_following")
    return versions.select(
        entity,
        *attributes,
        "start_time",
        F.coalesce(following, F.lit(OPEN_END).cast("timestamp")).alias("end_time"),
        following.isNull().alias("is_active"),
    )


def int_dim_user(
    auth: DataFrame,
    listen: DataFrame,
    page_view: DataFrame,
    status_change: DataFrame,
    seconds: Width = CHUNK_SECONDS,
) -> DataFrame:
    observations = user_observations(auth, listen, page_view, status_change, seconds=seconds)
    return keyed_periods(effective_periods(observations, seconds=seconds))


def keyed_periods(periods: DataFrame) -> DataFrame:
    """The user dimension: each period with its key."""
    return periods.select(
        surrogate_key("user_id", "start_time").alias("user_key"),
        "user_id", "user_last_name", "user_first_name", "user_gender", "registered_at",
        "user_agent", "start_time", "end_time", "is_active",
    )
