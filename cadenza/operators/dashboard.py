"""The pre-joined play table and the filter values."""

from pyspark.sql import DataFrame, functions as F

from cadenza.functions.clock import iso_weekday
from cadenza.functions.labels import label


def song_plays(
    fact: DataFrame, locations: DataFrame, users: DataFrame, songs: DataFrame
) -> DataFrame:
    """One row per play with resolved labels. Each dimension is cut to key and label before its
    join; plays of one key (the Unknown member above all) are split by AQE if they are many."""
    at = F.col("play_started_at")
    plays = fact.select(
        "play_key", "user_id", "user_key", "song_key", "location_key", "play_started_at",
        "listened_seconds", "updated_time",
    )
    return (
        plays.join(
            locations.select("location_key", label(F.col("location_state")).alias("state")),
            "location_key",
            "left",
        )
        .join(users.select("user_key", label(F.col("user_gender")).alias("gender")),
              "user_key", "left")
        .join(
            songs.select(
                "song_key",
                label(F.col("song_name")).alias("song"),
                label(F.col("song_artist_name")).alias("artist"),
            ),
            "song_key",
            "left",
        )
        .select(
            "play_key", "user_id", "song_key", "location_key", "play_started_at",
            "listened_seconds",
            # A key without a dimension row is labelled Unknown as well.
            *[label(F.col(c)).alias(c) for c in ("state", "gender", "song", "artist")],
            F.to_date(at).alias("play_date"),
            iso_weekday(at).alias("weekday"),
            F.hour(at).alias("hour"),
            "updated_time",
        )
    )


def filter_options(locations: DataFrame, users: DataFrame) -> DataFrame:
    """From the full dimensions, so values without plays are offered too."""
    states = locations.select(
        F.lit("states").alias("filter_name"), label(F.col("location_state")).alias("filter_value")
    )
    genders = users.select(
        F.lit("genders").alias("filter_name"), label(F.col("user_gender")).alias("filter_value")
    )
    return states.distinct().unionByName(genders.distinct()).orderBy("filter_name", "filter_value")
