"""Parameterised reports over the dashboard play table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cadenza.functions.labels import UNKNOWN
from cadenza.operators.marts import UNKNOWN_KEY, source_identity

TOP = 5

def _known_song() -> Column:
    return F.col("song_key") != UNKNOWN_KEY


def _plays() -> Column:
    return F.count(F.lit(1)).alias("plays")


def _known_seconds() -> Column:
    # Summed as decimals: the same total in whatever order partitions arrive.
    seconds = F.sum(F.col("listened_seconds").cast("decimal(18,6)"))
    return F.coalesce(seconds.cast("double"), F.lit(0.0)).alias("known_seconds")


def reject_bad_tables(
    song_plays: DataFrame | None, filter_options: DataFrame | None, sound: bool | None = None
) -> None:
    """Both tables are there and the play key is present and unique. ``sound`` is the verdict
    stored with the version of the table, if there is one: then no key is counted again."""
    if song_plays is None or filter_options is None:
        raise ValueError("dashboard tables are missing; run the warehouse cycle first")
    if sound is None:
        sound = source_identity(song_plays).first()["is_valid"]
    if not sound:
        raise ValueError("song_plays.play_key has missing or repeated keys")


def metadata(song_plays: DataFrame) -> DataFrame:
    """R1, figures."""
    return song_plays.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("play_started_at").isNull()).alias("missing_timestamp"),
        F.min("play_date").alias("min_date"),
        F.max("play_date").alias("max_date"),
        F.max("updated_time").alias("updated_at"),
        F.max("play_started_at").alias("latest_event"),
    )


def filter_values(filter_options: DataFrame, name: str) -> DataFrame:
    """R1, the sorted choices of one filter ('states' or 'genders')."""
    return (
        filter_options.filter(F.col("filter_name") == name)
        .select("filter_value")
        .orderBy("filter_value")
    )


def load_metadata(song_plays: DataFrame, filter_options: DataFrame) -> dict[str, DataFrame]:
    reject_bad_tables(song_plays, filter_options)
    return {
        "figures": metadata(song_plays),
        "states": filter_values(filter_options, "states"),
        "genders": filter_values(filter_options, "genders"),
    }


def days_of(song_plays: DataFrame, start: date, end: date) -> DataFrame:
    """The folders of a range of dates in the stored play table, which has one for each date: the
    others are not opened. Plays without a time are in none of them."""
    return song_plays.filter(F.col("play_date").between(start, end))


def select_plays(
    song_plays: DataFrame,
    start: date,
    end: date,
    states: Sequence[str] = (),
    genders: Sequence[str] = (),
) -> DataFrame:
    """R2: inclusive UTC dates; an empty selection means all. The bounds are on the raw timestamp,
    so they reach the Parquet scan; plays without a time drop out."""
    if start > end:
        raise ValueError("the start date must not be after the end date")
    at = F.col("play_started_at")
    chosen = song_plays.filter(
        (at >= F.lit(str(start)).cast("timestamp"))
        & (at < F.lit(str(end + timedelta(days=1))).cast("timestamp"))
    )
    for column, values in (("state", states), ("gender", genders)):
        if values:
            chosen = chosen.filter(F.col(column).isin(*values))
    return chosen.select(
        "play_key", "user_id", "song_key", "location_key", "play_started_at", "listened_seconds",
        "state", "gender", "song", "artist", "weekday", "hour",
    )


def summary(plays: DataFrame) -> DataFrame:
    """R3."""
    listener = F.when(F.col("user_id") != -1, F.col("user_id"))
    return plays.agg(
        _plays(),
        F.count_distinct(listener).alias("listeners"),
        F.count_distinct(F.when(_known_song(), F.col("song_key"))).alias("songs"),
        _known_seconds(),
        F.count_if(F.col("listened_seconds").isNull()).alias("duration_missing"),
        F.count_if(F.col("state") == UNKNOWN).alias("unknown_location"),
        F.count_if(F.col("song_key") == UNKNOWN_KEY).alias("unknown_song"),
        F.count_if(F.col("gender") == UNKNOWN).alias("unknown_gender"),
    )


def top_states(plays: DataFrame, n: int = TOP) -> DataFrame:
    """R4."""
    counts = plays.filter(F.col("state") != UNKNOWN).groupBy("state").agg(_plays())
    return counts.orderBy(F.desc("plays"), "state").limit(n)


_SONG = ["song", "artist", "song_key"]


def top_songs(plays: DataFrame, n: int = TOP) -> DataFrame:
    """R5."""
    counts = plays.filter(_known_song()).groupBy("song_key", "song", "artist").agg(_plays())
    return counts.orderBy(F.desc("plays"), *_SONG).limit(n)


def top_song_per_gender(plays: DataFrame) -> DataFrame:
    """The first song of each gender as a minimum, so a gender's songs are merged map-side
    instead of being sorted in one task."""
    counts = plays.filter(_known_song()).groupBy("gender", *_SONG).agg(_plays())
    best = counts.groupBy("gender").agg(
        F.min(F.struct((-F.col("plays")).alias("rank"), *_SONG, "plays")).alias("best")
    )
    return best.select("gender", "best.song_key", "best.song", "best.artist", "best.plays").orderBy(
        "gender"
    )


def hourly_heatmap(plays: DataFrame) -> DataFrame:
    """All 168 cells of a week, empty ones 0."""
    cells = plays.groupBy("weekday", "hour").agg(
        _plays(), _known_seconds(), F.count("listened_seconds").alias("measured_plays")
    )
    return _whole_week(cells)


def _whole_week(cells: DataFrame) -> DataFrame:
    """The grid is one range of hours of the week; there are no more cells to broadcast."""
    slot = F.col("id")
    grid = cells.sparkSession.range(7 * 24).select(
        (F.floor(slot / 24) + 1).cast("int").alias("weekday"), (slot % 24).cast("int").alias("hour")
    )
    return (
        grid.join(F.broadcast(cells), ["weekday", "hour"], "left")
        .select(
            "weekday",
            "hour",
            F.coalesce("plays", F.lit(0)).alias("plays"),
            F.coalesce("known_seconds", F.lit(0.0)).alias("known_seconds"),
            F.coalesce("measured_plays", F.lit(0)).alias("measured_plays"),
        )
        .orderBy("weekday", "hour")
    )


def daily_trend(plays: DataFrame, start: date, end: date) -> DataFrame:
    """Every date of the range, ends included."""
    days = plays.groupBy(F.to_date("play_started_at").alias("date")).agg(_plays(), _known_seconds())
    return _whole_range(days, start, end)


def _whole_range(days: DataFrame, start: date, end: date) -> DataFrame:
    span = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    calendar = days.sparkSession.range(1).select(F.explode(span).alias("date"))
    return (
        calendar.join(days, "date", "left")
        .select(
            "date",
            F.coalesce("plays", F.lit(0)).alias("plays"),
            (F.coalesce("known_seconds", F.lit(0.0)) / 3600).alias("hours"),
        )
        .orderBy("date")
    )


def top_artists(plays: DataFrame, n: int = TOP) -> DataFrame:
    """R9."""
    known = plays.filter(_known_song() & (F.col("artist") != UNKNOWN))
    return known.groupBy("artist").agg(_plays()).orderBy(F.desc("plays"), "artist").limit(n)


def derived_figures(totals: DataFrame) -> DataFrame:
    """R10, over R3: share of plays with a duration, and hours; NULL share without plays."""
    plays = F.col("plays")
    measured = (plays - F.col("duration_missing")) / F.nullif(plays, F.lit(0)) * 100
    return totals.select(
        "plays", measured.alias("coverage_percent"), (F.col("known_seconds") / 3600).alias("hours")
    )


def peak_hour(heatmap: DataFrame, totals: DataFrame) -> DataFrame:
    """R11, over R7 and R3: the busiest cell, ties to the earliest, and its share of all plays."""
    best = heatmap.orderBy(F.desc("plays"), "weekday", "hour").limit(1)
    return best.select(
        "weekday",
        "hour",
        "plays",
        (F.col("plays") / F.nullif(totals.select("plays").scalar(), F.lit(0))).alias("share"),
    )


def leading_songs(songs: DataFrame, totals: DataFrame) -> DataFrame:
    """R12, over R5 and R3: ranked labels and each song's share of all selected plays. The ranking
    is over the top five only."""
    order = F.array_sort(F.collect_list(F.struct((-F.col("plays")).alias("rank"), *_SONG, "plays")))
    ranked = songs.agg(order.alias("ranked")).select(F.posexplode("ranked").alias("at", "top"))
    place = F.col("at") + 1
    return ranked.select(
        place.alias("place"),
        F.concat(place.cast("string"), F.lit(". "), "top.song", F.lit(" — "), "top.artist").alias(
            "label"
        ),
        F.col("top.plays").alias("plays"),
        (F.col("top.plays") / F.nullif(totals.select("plays").scalar(), F.lit(0))).alias("share"),
    )


#: What the reports group the selected plays by; a set's name is the report it serves.
_SETS = {
    "all": [],
    "listeners": ["user_id"],
    "states": ["state"],
    "songs": _SONG,
    "gender_songs": ["gender", *_SONG],
    "hourly": ["weekday", "hour"],
    "daily": ["date"],
    "artists": ["known_artist"],
}


def report_groups(plays: DataFrame) -> DataFrame:
    """All groups that the seven reports need, by one scan of the selection: grouping sets, merged
    map-side. Distinct listeners and songs are then numbers of groups, which is exact."""
    known = plays.select(
        F.to_date("play_started_at").alias("date"), "weekday", "hour", "state", "gender", *_SONG,
        F.when(_known_song(), F.col("artist")).alias("known_artist"),
        F.when(F.col("user_id") != -1, F.col("user_id")).alias("user_id"),
        "listened_seconds",
    )
    columns = ["user_id", "state", "gender", *_SONG, "known_artist", "weekday", "hour", "date"]
    sets = [[F.col(c) for c in group] for group in _SETS.values()]
    measured = F.col("listened_seconds")
    groups = known.groupingSets(sets, *columns).agg(
        F.grouping_id(*columns).alias("_set"),
        _plays(),
        F.sum(measured.cast("decimal(18,6)")).alias("seconds"),
        F.count(measured).alias("measured_plays"),
    )
    name = F.lit(None).cast("string")
    for set_name, group in _SETS.items():
        # The bit of a column is set where the set leaves the column out.
        number = sum(1 << n for n, c in enumerate(reversed(columns)) if c not in group)
        name = F.when(F.col("_set") == number, set_name).otherwise(name)
    return groups.withColumn("report", name).drop("_set")


def _of(groups: DataFrame, name: str) -> DataFrame:
    return groups.filter(F.col("report") == name)


def _seconds() -> Column:
    return F.coalesce(F.col("seconds").cast("double"), F.lit(0.0))


def summary_of(groups: DataFrame) -> DataFrame:
    """R3, from the groups."""

    def plays_of(name: str, which: Column) -> Column:
        found = F.sum(F.when((F.col("report") == name) & which, F.col("plays")))
        return F.coalesce(found, F.lit(0))

    def number(name: str, column: str) -> Column:
        return F.count_if((F.col("report") == name) & F.col(column).isNotNull())

    whole = F.col("report") == "all"
    return groups.agg(
        plays_of("all", F.lit(True)).alias("plays"),
        number("listeners", "user_id").alias("listeners"),
        # A key with two spellings is one song.
        F.count_distinct(
            F.when((F.col("report") == "songs") & _known_song(), F.col("song_key"))
        ).alias("songs"),
        F.coalesce(F.max(F.when(whole, F.col("seconds"))).cast("double"), F.lit(0.0)).alias(
            "known_seconds"
        ),
        F.coalesce(
            F.max(F.when(whole, F.col("plays") - F.col("measured_plays"))), F.lit(0)
        ).alias("duration_missing"),
        plays_of("states", F.col("state") == UNKNOWN).alias("unknown_location"),
        plays_of("songs", F.col("song_key") == UNKNOWN_KEY).alias("unknown_song"),
        plays_of("gender_songs", F.col("gender") == UNKNOWN).alias("unknown_gender"),
    )


def _ranking(found: DataFrame, columns: list[str], n: int) -> DataFrame:
    return found.select(*columns, "plays").orderBy(F.desc("plays"), *columns).limit(n)


def reports_of(groups: DataFrame, start: date, end: date, n: int = TOP) -> dict[str, DataFrame]:
    """R3-R9 from the groups: no report reads the plays again."""
    rank = F.struct((-F.col("plays")).alias("rank"), *_SONG, "plays")
    by_gender = _of(groups, "gender_songs").filter(_known_song()).groupBy("gender")
    best = by_gender.agg(F.min(rank).alias("best"))
    cells = _of(groups, "hourly").select(
        "weekday", "hour", "plays", _seconds().alias("known_seconds"), "measured_plays"
    )
    days = _of(groups, "daily").select("date", "plays", _seconds().alias("known_seconds"))
    songs = _ranking(_of(groups, "songs").filter(_known_song()), _SONG, n)
    artists = _of(groups, "artists").select(F.col("known_artist").alias("artist"), "plays")
    return {
        "summary": summary_of(groups),
        "states": _ranking(_of(groups, "states").filter(F.col("state") != UNKNOWN), ["state"], n),
        "songs": songs.select("song_key", "song", "artist", "plays"),
        "gender_songs": best.select(
            "gender", "best.song_key", "best.song", "best.artist", "best.plays"
        ).orderBy("gender"),
        "hourly": _whole_week(cells),
        "daily": _whole_range(days, start, end),
        "artists": _ranking(artists.filter(F.col("artist") != UNKNOWN), ["artist"], n),
    }


def load_report(
    song_plays: DataFrame,
    start: date,
    end: date,
    states: Sequence[str] = (),
    genders: Sequence[str] = (),
    keep: Callable[[DataFrame], DataFrame] = lambda groups: groups,
) -> dict[str, DataFrame]:
    """The named reports for one selection, from one set of groups. ``keep`` may write the
    groups down (they are as many as distinct listeners and songs), so that the selection is scanned
    once for all reports; otherwise each report that is run scans it."""
    plays = select_plays(song_plays, start, end, states, genders)
    return reports_of(keep(report_groups(plays)), start, end)


_CONTENT = ["song_key", "song", "artist", "state", "gender"]


def report_rows(bundle: dict[str, DataFrame]) -> DataFrame:
    """R13 as one table: a row for each row of each report, its place there, and its values; columns
    that a report does not have are NULL."""
    parts = []
    for name, df in bundle.items():
        if name == "summary":
            figures = [F.struct(F.lit(c).alias("figure"), F.col(c).cast("double").alias("value"))
                       for c in df.columns]
            rows = df.select(F.inline(F.array(*figures)))
        elif name == "hourly":
            rows = df.withColumnRenamed("known_seconds", "value")
        elif name == "daily":
            rows = df.withColumnRenamed("hours", "value")
        else:
            rows = df
        parts.append(rows.withColumn("report", F.lit(name)))
    kinds = {f.name: f.dataType for p in parts for f in p.schema}
    order = ["report", "figure", "date", "weekday", "hour", *_CONTENT, "plays", "measured_plays",
             "value"]
    return reduce(
        DataFrame.unionByName,
        [
            p.select(*[
                F.col(c) if c in p.columns else F.lit(None).cast(kinds[c]).alias(c) for c in order
            ])
            for p in parts
        ],
    )
