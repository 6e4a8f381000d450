"""Ordered per-entity work in bounded tasks.

A plain ``Window.partitionBy(user).orderBy(ts)`` puts a whole user into one task, however many rows
that user has. Here an entity's history is cut into time chunks: windows run inside one
(entity, chunk), and what must cross a chunk edge - the row before, the row after, a running total -
travels as one small row per chunk. A chunk can hold no more than the events of its time span, and
an entity no more chunk rows than its history has spans, so both steps stay small for an entity that
owns a third of all rows.

A burst may put very many events of one entity into one span. Such cells are counted first and cut at
quantiles of their times (``chunks_for``): a chunk's number is then its span and its place in it, in
time order as before, so all that works on chunks works on the pieces.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

CHUNK = "_chunk"
CHUNK_SECONDS = 3600
_ROWS_PER_CHUNK = 50_000_000

# Rows without a time sort last, so they form the last chunk.
_LAST_CHUNK = 2**62


def chunk_of(ts: Column, seconds: int = CHUNK_SECONDS) -> Column:
    number = F.floor(F.unix_seconds(ts) / seconds).cast("bigint")
    return F.coalesce(number, F.lit(_LAST_CHUNK).cast("bigint"))


def chunk_seconds_for(events: DataFrame, ts: str = "ts") -> int:
    """A chunk width for this data, from a minute to a day: if one entity owned every event, its
    chunks would hold about 50 million at the usual rate, that of the middle 98 % of the events; a
    few wrong times do not stretch it. Wide chunks mean fewer edge rows."""
    seconds = F.unix_seconds(ts)
    rows, ends = events.agg(
        F.count(ts), F.percentile_approx(seconds, [0.01, 0.99], 10_000)
    ).first()
    if not rows:
        return CHUNK_SECONDS
    span = (ends[1] - ends[0]) / 0.98 + 1
    return int(min(max(span * _ROWS_PER_CHUNK / rows, 60), 86_400))


#: Pieces a cell may have, and rows a cell may hold before it is cut.
_PIECES = 1024
_ROWS_PER_CELL = 2_000_000
#: Cells that are sent to all tasks; more of them are joined.
_MOST_BROADCAST = 10_000


@dataclass(frozen=True)
class Chunks:
    """A width in seconds, and the cuts of the cells that hold too much: ``_who``, ``_cell``, ``_cuts``
    (times in microseconds, ascending)."""

    seconds: int
    splits: DataFrame | None = None
    few: bool = True

    def add(self, df: DataFrame, ts: str, entity: str) -> DataFrame:
        plain = chunk_of(F.col(ts), self.seconds)
        if self.splits is None:
            return df.withColumn(CHUNK, plain)
        # At most _MOST_BROADCAST rows, counted, of at most _PIECES numbers.
        side = F.broadcast(self.splits) if self.few else self.splits
        same = F.col(entity).eqNullSafe(F.col("_who")) & (F.col("_plain") == F.col("_cell"))
        cuts = F.coalesce("_cuts", F.array().cast("array<bigint>"))
        before = F.size(F.filter(cuts, lambda cut: cut <= F.unix_micros(F.col(ts))))
        last = F.lit(_LAST_CHUNK).cast("bigint")
        number = F.when(F.col("_plain") == last, last).otherwise(F.col("_plain") * _PIECES + before)
        joined = df.withColumn("_plain", plain).join(side, same, "left")
        return joined.select(*df.columns, number.alias(CHUNK))


Width = int | Chunks


def with_chunk(
    df: DataFrame, ts: str, seconds: Width = CHUNK_SECONDS, entity: str = "userId"
) -> DataFrame:
    chunks = seconds if isinstance(seconds, Chunks) else Chunks(seconds)
    return chunks.add(df, ts, entity)


def chunks_for(
    rows: DataFrame,
    entity: str,
    ts: str,
    seconds: int,
    keep: Callable[[DataFrame], DataFrame],
    most: int = _ROWS_PER_CELL,
) -> Chunks:
    """Chunks in which no cell of (entity, span) holds far more than ``most`` of these rows, unless
    they are of one time. ``keep`` writes the cuts down, as each step reads them; without such a
    cell there is nothing to cut and nothing to read."""
    cells = with_chunk(rows, ts, seconds, entity)
    hot = cells.groupBy(entity, CHUNK).agg(F.count(F.lit(1)).alias("_n")).filter(
        (F.col("_n") > most) & (F.col(CHUNK) != _LAST_CHUNK)
    )
    number, largest = hot.agg(F.count(F.lit(1)), F.max("_n")).first()
    if not number:
        return Chunks(seconds)
    pieces = min(_PIECES, 2 ** math.ceil(math.log2(largest / most) + 1))
    few = number <= _MOST_BROADCAST
    which = hot.select(F.col(entity).alias("_who"), F.col(CHUNK).alias("_cell"))
    same = F.col(entity).eqNullSafe(F.col("_who")) & (F.col(CHUNK) == F.col("_cell"))
    # Quantiles are sketches, merged map-side: a hot cell meets in no task.
    splits = (
        cells.join(F.broadcast(which) if few else which, same)
        .groupBy("_who", "_cell")
        .agg(
            F.array_distinct(
                F.percentile_approx(
                    F.unix_micros(ts), [k / pieces for k in range(1, pieces)], 10 * pieces
                )
            ).alias("_cuts")
        )
    )
    return Chunks(seconds, keep(splits), few)


def in_chunk(group: list[str], order: list[Column]) -> WindowSpec:
    return Window.partitionBy(*group, CHUNK).orderBy(*order)


def carry(
    rows: DataFrame,
    edges: DataFrame,
    group: list[str],
    carried: Callable[[WindowSpec], dict[str, Column]],
) -> DataFrame:
    """Add to ``rows`` values taken from other chunks of the same entity.

    ``edges`` has one row per (group, chunk); ``carried`` builds columns over an entity's edges in
    time order. ``rows`` are already partitioned by (group, chunk) after a window over one chunk, so
    only the edges move.
    """
    spec = Window.partitionBy(*group).orderBy(CHUNK)
    columns = [value.alias(name) for name, value in carried(spec).items()]
    return rows.join(edges.select(*group, CHUNK, *columns), [*group, CHUNK], "left")
