"""The play fact - next event on the session timeline and six dimension lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cadenza.functions.clock import second_of_day, seconds_between
from cadenza.functions.keys import surrogate_key
from cadenza.operators.ordered import CHUNK, CHUNK_SECONDS, Width, carry, in_chunk, with_chunk

EVENT_ID = ["userId", "sessionId", "ts", "itemInSession"]
CONFLICT = "Conflicting event timestamps in play timeline"

FACT_COLUMNS = [
    "play_key", "user_id", "session_id", "item_in_session", "user_key", "song_key", "session_key",
    "location_key", "play_date_key", "play_time_key", "play_started_at", "play_ended_at",
    "listened_seconds",
]


_UNMATCHED_CHUNKS = 1 << 16


def _play_chunks(plays: DataFrame, seconds: Width) -> DataFrame:
    """Plays with their chunk. No lookup by user and time can match a play without one of them;
    such plays are dealt over many chunks of their own (below any real one), so that logged-out
    listeners are no hot key."""
    spread = F.pmod(F.xxhash64(*plays.columns), F.lit(_UNMATCHED_CHUNKS))
    unmatched = F.col("userId").isNull() | F.col("ts").isNull()
    return with_chunk(plays, "ts", seconds).withColumn(
        CHUNK, F.when(unmatched, F.lit(-(2**62)) + spread).otherwise(F.col(CHUNK))
    )


def event_ids(listen: DataFrame, page_view: DataFrame) -> DataFrame:
    return listen.select(*EVENT_ID).unionByName(page_view.select(*EVENT_ID))


def timeline(listen: DataFrame, page_view: DataFrame) -> DataFrame:
    """an event reported by both streams counts once."""
    return event_ids(listen, page_view).distinct()


def session_instants(
    events: DataFrame, seconds: Width = CHUNK_SECONDS, known_only: bool = False
) -> DataFrame:
    """One row per (user, session, time) with the next time of that session.

    Events at one time are ordered by item, so all but the last of them end at that same time; the
    last ends at the next distinct time. Grouping first means that ties, however many, are merged
    before the window, and repeated rows of the timeline need no distinct of their own.

    ``known_only`` leaves out events without a user, session or time, which no play can match; the
    rest is then partitioned as the plays are in F12, by (user, chunk).
    """
    item = F.col("itemInSession")
    dealt = []
    if known_only:
        # Dealt first, so that the grouping and the window share one shuffle.
        events = with_chunk(events.dropna(subset=["userId", "sessionId", "ts"]), "ts", seconds)
        events, dealt = events.repartition("userId", CHUNK), [CHUNK]
    instants = events.groupBy("userId", "sessionId", "ts", *dealt).agg(
        F.max(item).alias("last_item"), F.bool_or(item.isNull()).alias("open_item")
    )
    if known_only:
        session = ["userId", "sessionId"]
        rows = instants
    else:
        # A struct keeps sessions without a user or id together and joinable.
        session = ["_session"]
        rows = with_chunk(
            instants.withColumn("_session", F.struct("userId", "sessionId")), "ts", seconds
        )
    spec = in_chunk(session, [F.col("ts").asc_nulls_last()])
    local = rows.withColumn("_next", F.lead("ts").over(spec))
    edges = rows.groupBy(*session, CHUNK).agg(F.min("ts").alias("_first"))
    linked = carry(local, edges, session, lambda w: {"_later": F.lead("_first").over(w)})
    kept = ["userId", "sessionId", "ts", "last_item", "open_item"]
    return linked.select(
        *kept, F.coalesce("_next", "_later").alias("next_ts"), *([CHUNK] if known_only else [])
    )


def _ends_at(item: Column) -> Column:
    followed = F.col("open_item") | (item < F.col("last_item"))
    return F.when(item.isNotNull() & followed, F.col("ts")).otherwise(F.col("next_ts"))


def next_event(events: DataFrame, seconds: Width = CHUNK_SECONDS) -> DataFrame:
    """each timeline event with the time of the event after it in its session."""
    instants = session_instants(events, seconds)
    at = instants.select(
        F.struct("userId", "sessionId", "ts").alias("_at"), "last_item", "open_item", "next_ts"
    )
    rows = events.withColumn("_at", F.struct("userId", "sessionId", "ts"))
    return rows.join(at, "_at", "left").select(
        *EVENT_ID, _ends_at(F.col("itemInSession")).alias("play_ended_at")
    )


def _same_partitions(
    plays: DataFrame, side: DataFrame, keys: list[str], seconds: Width
) -> tuple[DataFrame, list[str]]:
    """If the plays carry their chunk, join on it too: it follows from the time, so the result is
    the same, and plays partitioned by (user, chunk) need no shuffle of their own."""
    if CHUNK not in plays.columns:
        return side.drop(CHUNK), keys
    if CHUNK not in side.columns:
        side = with_chunk(side, "ts", seconds)
    return side, [*keys, CHUNK]


def attach_end_time(
    plays: DataFrame, instants: DataFrame, seconds: Width = CHUNK_SECONDS
) -> DataFrame:
    """plain equality, so a play with a missing id survives without an end."""
    side, keys = _same_partitions(plays, instants, ["userId", "sessionId", "ts"], seconds)
    joined = plays.join(side, keys, "left")
    item = F.col("itemInSession")
    return joined.select(
        *plays.columns, F.when(item.isNotNull(), _ends_at(item)).alias("play_ended_at")
    )


def lookup(dim: DataFrame, *columns: str) -> DataFrame:
    """exact copies of a dimension row do not fan out; ambiguous rows do, and checks see it."""
    return dim.select(*columns).distinct()


def attach_date(plays: DataFrame, dates: DataFrame) -> DataFrame:
    """F4. Broadcast: a calendar has at most 3.7 million days, years 1 to 9999."""
    days = lookup(dates, "date_key").withColumnRenamed("date_key", "play_date_key")
    return plays.join(F.broadcast(days), F.to_date(F.col("ts")) == F.col("play_date_key"), "left")


def attach_time(plays: DataFrame, times: DataFrame) -> DataFrame:
    """F5. Broadcast: a day has 86,400 seconds."""
    keys = lookup(times, "time_key").withColumnRenamed("time_key", "play_time_key")
    return plays.join(
        F.broadcast(keys), second_of_day(F.col("ts")) == F.col("play_time_key"), "left"
    )


def overlapping_periods(users: DataFrame, seconds: Width = CHUNK_SECONDS) -> DataFrame:
    """Periods that reach past the start of the same user's next period."""
    periods = _periods(users).withColumnRenamed("ts", "start_time")
    order = [F.col("start_time"), F.col("_period.end_time"), F.col("_period.user_key")]
    rows = with_chunk(periods, "start_time", seconds)
    spec = in_chunk(["userId"], order)
    local = rows.withColumn("_next", F.lead("start_time").over(spec))
    edges = rows.groupBy("userId", CHUNK).agg(F.min("start_time").alias("_first"))
    linked = carry(local, edges, ["userId"], lambda w: {"_later": F.lead("_first").over(w)})
    return linked.filter(
        F.col("_period.end_time") > F.coalesce("_next", "_later")
    ).select("userId", "_period.*")


_LEVELS = 38  # aligned intervals of 1, 2, 4 ... seconds, up to more than 8,000 years


def _second(micros: str, up: bool = False) -> Column:
    """Whole seconds since the year 1, cut or rounded up."""
    return F.expr(f"({micros} + 62135596800000000{' + 999999' if up else ''}) div 1000000")


def _aligned(users: DataFrame) -> DataFrame:
    """Each period as the aligned intervals (level, number) that make up its seconds: at most two of
    each length, so their number grows with the logarithm of the period. Its first and last second
    may be covered in part."""
    begin = _second("unix_micros(_period.start_time)")
    end = _second("unix_micros(_period.end_time)", up=True)
    spans = _periods(users).withColumns({"_begin": begin, "_end": end})
    # What is left of the span in whole intervals of a level: an odd end belongs to no longer one.
    parts = F.expr(f"""
        flatten(transform(sequence(0, {_LEVELS}), level -> transform(
            filter(
                array(
                    struct((_begin + shiftleft(1L, level) - 1) div shiftleft(1L, level) as number, 0 as side),
                    struct(_end div shiftleft(1L, level) - 1 as number, 1 as side)
                ),
                p -> (_begin + shiftleft(1L, level) - 1) div shiftleft(1L, level)
                        < _end div shiftleft(1L, level)
                    and p.number % 2 = 1 - p.side
            ),
            p -> struct(level, p.number as number)
        )))""")
    return spans.select("userId", "_period", F.explode(parts).alias("_at")).select(
        "userId", "_period", F.col("_at.level").alias("_level"), F.col("_at.number").alias("_number")
    )


def _attach_overlapping(plays: DataFrame, users: DataFrame) -> DataFrame:
    """Every version that covers a play. A play lies in one aligned interval of each length, and of
    those that make up a period in one at most: equal intervals join, then the exact bounds decide.
    Levels that no period uses are not tried. A hot user is spread over the intervals; the few of
    the longest levels, which all plays share, are left to AQE's skew join."""
    index = _aligned(users)
    levels = sorted(r[0] for r in index.select("_level").distinct().collect())  # at most 39
    nobody = F.lit(None).cast("string").alias("user_key")
    if not levels:
        return plays.select("*", nobody)
    known = plays.filter(F.col("userId").isNotNull() & F.col("ts").isNotNull())
    second = _second("unix_micros(ts)")
    chain = F.array(
        *[
            F.struct(F.lit(n).alias("level"), F.shiftright(second, n).alias("number"))
            for n in levels
        ]
    )
    tried = known.select(*plays.columns, F.explode(chain).alias("_at")).select(
        *plays.columns, F.col("_at.level").alias("_level"), F.col("_at.number").alias("_number")
    )
    at = F.col("ts")
    covers = (at >= F.col("_period.start_time")) & (at < F.col("_period.end_time"))
    found = (
        tried.join(index, ["userId", "_level", "_number"])
        .filter(covers)
        .select(*plays.columns, F.col("_period.user_key").alias("user_key"))
    )
    covered = found.select("userId", "ts").distinct()
    alone = plays.join(covered, ["userId", "ts"], "left_anti")
    return found.unionByName(alone.select(*plays.columns, nobody))


def _periods(users: DataFrame, copies: bool = False) -> DataFrame:
    columns = ["user_key", "user_id", "start_time", "end_time"]
    valid = (users.select(*columns) if copies else lookup(users, *columns)).filter(
        F.col("user_id").isNotNull() & (F.col("start_time") < F.col("end_time"))
    )
    return valid.select(
        F.col("user_id").alias("userId"),
        F.col("start_time").alias("ts"),
        F.struct("start_time", "end_time", "user_key").alias("_period"),
    )


def attach_user(
    plays: DataFrame,
    users: DataFrame,
    disjoint: bool | None = None,
    seconds: Width = CHUNK_SECONDS,
) -> DataFrame:
    """the user version valid at the play, start <= ts < end.

    With periods that do not overlap (any history built by D11) the version is the last one started
    by then, so plays and period starts are merged on one time line per user: work is linear even if
    a single user owns a third of the plays and changes at each of them, where an interval join
    would compare every play with every version. ``disjoint=None`` looks for overlaps first; with
    overlaps each play meets all the versions that cover it, found by an index of aligned intervals.
    """
    if disjoint is None:
        disjoint = overlapping_periods(users, seconds).isEmpty()
    if not disjoint:
        return _attach_overlapping(plays, users)

    # Copies of a period are harmless here: the last one started is the same.
    starts = with_chunk(_periods(users, copies=True), "ts", seconds)
    listens = plays if CHUNK in plays.columns else _play_chunks(plays, seconds)
    merged = listens.withColumn("_is_play", F.lit(True)).unionByName(
        starts.withColumn("_is_play", F.lit(False)), allowMissingColumns=True
    )
    # At equal times the period comes first: it already covers a play at its start.
    spec = in_chunk(["userId"], [F.col("ts").asc_nulls_last(), F.col("_is_play")]).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = merged.withColumn("_here", F.last("_period", ignorenulls=True).over(spec)).filter(
        "_is_play"
    )
    last_started = starts.groupBy("userId", CHUNK).agg(F.max("_period").alias("_last"))
    known = listens.filter(F.col("userId").isNotNull() & F.col("ts").isNotNull())
    chunks = known.select("userId", CHUNK).distinct().unionByName(
        last_started, allowMissingColumns=True
    )
    by_chunk = Window.partitionBy("userId").orderBy(CHUNK)
    before = chunks.select(
        "userId",
        CHUNK,
        "_last",
        F.last("_last", ignorenulls=True)
        .over(by_chunk.rangeBetween(Window.unboundedPreceding, -1))
        .alias("_before"),
    )
    before = before.filter(F.col("_last").isNull()).drop("_last")
    found = local.join(before, ["userId", CHUNK], "left").withColumn(
        "_found", F.coalesce("_here", "_before")
    )
    valid = F.col("ts") < F.col("_found.end_time")
    return found.select(*plays.columns, F.when(valid, F.col("_found.user_key")).alias("user_key"))


def _null_safe(pairs: dict[str, str]) -> Column:
    condition = F.lit(True)
    for play_column, dim_column in pairs.items():
        condition = condition & F.col(play_column).eqNullSafe(F.col(dim_column))
    return condition


def attach_song(plays: DataFrame, songs: DataFrame) -> DataFrame:
    """missing values match missing values. An equi join: Spark broadcasts the songs if they
    are measured small, else sort-merges, and AQE splits a hot song's plays."""
    pairs = {
        "artist": "song_artist_name", "song": "song_name", "duration": "song_duration_seconds",
    }
    side = lookup(songs, "song_key", *pairs.values())
    return plays.join(side, _null_safe(pairs), "left").drop(*pairs.values())


def attach_location(plays: DataFrame, locations: DataFrame) -> DataFrame:
    """F8: as F7 over five columns."""
    pairs = {c: f"location_{c}" for c in ("city", "zip", "state", "lon", "lat")}
    side = lookup(locations, "location_key", *pairs.values())
    return plays.join(side, _null_safe(pairs), "left").drop(*pairs.values())


def attach_session(
    plays: DataFrame, sessions: DataFrame, seconds: Width = CHUNK_SECONDS
) -> DataFrame:
    """the session event of the same user, session, time and position."""
    side = sessions.select(
        "session_key",
        F.col("user_id").alias("userId"),
        F.col("session_id").alias("sessionId"),
        F.col("session_started_time").alias("ts"),
        F.col("session_number").alias("itemInSession"),
    )
    keys = EVENT_ID
    if CHUNK in plays.columns:
        # Dealt as the plays are before copies go: one shuffle for both.
        side, keys = _same_partitions(plays, side.dropna(subset=EVENT_ID), EVENT_ID, seconds)
        side = side.repartition("userId", CHUNK)
    return plays.join(lookup(side, *side.columns), keys, "left")


def shape_fact(plays: DataFrame) -> DataFrame:
    """durations, the play key and the final columns."""
    return plays.select(
        surrogate_key("userId", "sessionId", "itemInSession").alias("play_key"),
        F.col("userId").alias("user_id"),
        F.col("sessionId").alias("session_id"),
        F.col("itemInSession").alias("item_in_session"),
        "user_key", "song_key", "session_key", "location_key", "play_date_key", "play_time_key",
        F.col("ts").alias("play_started_at"),
        "play_ended_at",
        seconds_between(F.col("ts"), F.col("play_ended_at")).alias("listened_seconds"),
    )


PLAY_COLUMNS = EVENT_ID + [
    "city", "zip", "state", "lon", "lat", "artist", "song", "duration",
]


def int_fact_song_play(
    listen: DataFrame,
    page_view: DataFrame,
    *,
    dates: DataFrame,
    times: DataFrame,
    users: DataFrame,
    songs: DataFrame,
    locations: DataFrame,
    sessions: DataFrame,
    disjoint: bool | None = None,
    seconds: Width = CHUNK_SECONDS,
) -> DataFrame:
    """the three lookups by user and time come first and share one partitioning of the plays
    (see ``session.SETTINGS``); each lookup then drops the columns it used."""
    plays = _play_chunks(listen.select(*PLAY_COLUMNS), seconds)
    plays = attach_user(plays, users, disjoint, seconds)
    plays = attach_session(plays, sessions, seconds)
    instants = session_instants(event_ids(listen, page_view), seconds, known_only=True)
    plays = attach_end_time(plays, instants, seconds).drop(CHUNK)
    plays = attach_song(plays, songs).drop("artist", "song", "duration")
    plays = attach_location(plays, locations).drop("city", "zip", "state", "lon", "lat")
    plays = attach_time(attach_date(plays, dates), times)
    return shape_fact(plays)


def timeline_conflicts(events: DataFrame) -> DataFrame:
    """positions of a session that were reported at more than one time."""
    spans = events.groupBy("userId", "sessionId", "itemInSession").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
    return spans.filter(F.col("first_ts") < F.col("last_ts"))


def reject_conflicts(events: DataFrame) -> None:
    """Events without a user, session or position name no place in a timeline: they stop no run."""
    known = events.dropna(subset=["userId", "sessionId", "itemInSession"])
    if not timeline_conflicts(known).isEmpty():
        raise ValueError(CONFLICT)
