"""Calendar, time of day, location, session and song dimensions."""

from pyspark.sql import DataFrame, functions as F

from cadenza.functions.clock import day_part, iso_weekday, second_of_day
from cadenza.functions.keys import surrogate_key


def int_dim_date(listen: DataFrame) -> DataFrame:
    day = F.col("date_key")
    return listen.select(F.to_date("ts").alias("date_key")).distinct().select(
        day,
        iso_weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        F.extract(F.lit("yearofweek"), day).cast("int").alias("iso_year_number"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter_number"),
        F.year(day).alias("year_number"),
        iso_weekday(day).isin(6, 7).alias("is_weekend"),
    )


def int_dim_time(listen: DataFrame) -> DataFrame:
    """One row per second of the day heard, at most 86,400; fractions are cut, not rounded."""
    key, hour, minute = F.col("time_key"), F.col("hour_number"), F.col("minute_number")
    seconds = listen.select(second_of_day(F.col("ts")).alias("time_key")).distinct()
    parts = seconds.select(
        key,
        F.floor(key / 3600).cast("int").alias("hour_number"),
        F.floor(key % 3600 / 60).cast("int").alias("minute_number"),
        (key % 60).cast("int").alias("second_number"),
    )
    return parts.select(
        key,
        F.when(
            key.isNotNull(), F.format_string("%02d:%02d:%02d", hour, minute, "second_number")
        ).alias("time_value"),
        hour,
        minute,
        "second_number",
        F.when(hour % 12 == 0, 12).otherwise(hour % 12).alias("hour_12"),
        F.when(hour < 12, "AM").otherwise("PM").alias("am_pm"),
        (hour * 60 + minute).alias("minute_of_day"),
        key.alias("second_of_day"),
        day_part(hour).alias("time_period"),
    )


LOCATION_GRAIN = [
    "location_city", "location_zip", "location_state", "location_lon", "location_lat",
]


def int_dim_location(page_view: DataFrame) -> DataFrame:
    grain = page_view.select(
        F.col("city").alias("location_city"),
        F.col("zip").alias("location_zip"),
        F.col("state").alias("location_state"),
        F.col("lon").alias("location_lon"),
        F.col("lat").alias("location_lat"),
    ).distinct()
    return grain.select(surrogate_key(*LOCATION_GRAIN).alias("location_key"), *LOCATION_GRAIN)


def int_dim_session(page_view: DataFrame) -> DataFrame:
    """One row per song event of a session; a projection, so nothing is shuffled."""
    heard = F.col("artist").isNotNull() | F.col("song").isNotNull() | F.col("duration").isNotNull()
    events = page_view.filter(heard).select(
        F.col("sessionId").alias("session_id"),
        F.col("userId").alias("user_id"),
        F.col("ts").alias("session_started_time"),
        F.col("itemInSession").alias("session_number"),
    )
    return events.select(
        surrogate_key("user_id", "session_id", "session_started_time").alias("session_key"), "*"
    )


def int_dim_song(listen: DataFrame) -> DataFrame:
    songs = listen.select(
        F.col("song").alias("song_name"),
        F.col("artist").alias("song_artist_name"),
        F.col("duration").alias("song_duration_seconds"),
    ).distinct()
    return songs.select(
        surrogate_key("song_artist_name", "song_name", "song_duration_seconds").alias("song_key"),
        "*",
    )
