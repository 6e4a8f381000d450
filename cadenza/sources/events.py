"""The four event streams, derived from the given ``events``, ``part``, ``nation`` and ``region``.

The mapping is declared once, as columns over one row per event, and works on a batch or a stream:

* click, view and purchase are songs (NextSong); signup is Home, error is Error;
* the song is the part numbered by the event's value in tenths, wrapped at the number of parts;
* the place is the user's nation, by user id;
* ``props.k`` plants what real feeds contain: a record delivered twice (k < 2), a song without a
  name (42), a page view that lost its song (58), a listen with a city no page view knows (59) and a
  missing user (97). No event is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cadenza.schemas import EVENT_SCHEMAS
from cadenza.sources.paths import is_dir

PLAY_TYPES = ["click", "view", "purchase"]
DELIVERY_COLUMNS = ["topic", "partition", "offset", "kafka_timestamp"]
_NEW_YEAR_MS = 1704067200000  # 2024-01-01
#: Events of one task of the lake's writer: it sorts whole records, of up to 2 kB each, by their day.
ROWS_PER_TASK = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1000) -> DataFrame:
    """The events table as a file stream, whether it is one file or a folder of files."""
    path = f"{sf_dir}/events.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option(
        "maxFilesPerTrigger", files_per_trigger
    )
    if is_dir(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def described_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``describe`` over the event stream, in tasks that hold a bounded number of events, near in
    time, whatever the files are cut into: a task writes a few of the daily folders. Songs are
    merged, as they grow with the table: a broadcast would pass through the driver for each topic."""
    events, part, nation, region = (
        table(spark, sf_dir, n) for n in ("events", "part", "nation", "region")
    )
    tasks = max(-(-events.count() // ROWS_PER_TASK), spark.sparkContext.defaultParallelism)
    stream = describe(event_stream(spark, sf_dir), part.hint("merge"), nation, region)
    return stream.repartitionByRange(tasks, "ts", "event_id")


def describe(events: DataFrame, part: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """One row per event with every field a topic may need."""
    parts = part.select(F.count(F.lit(1))).scalar()
    user, k = F.col("user_id"), F.get_json_object("props", "$.k").cast("int")
    # The wire carries milliseconds.
    ms = F.floor(
        F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
        / 1000
    )
    events = events.select(
        "event_id", "user_id", "event_type", k.alias("k"), ms.alias("ts_ms"),
        (F.floor(F.col("value") * 10) % parts).alias("song_no"),
        (user % 25).alias("place"),
    )
    songs = part.select(
        F.col("p_partkey").alias("song_no"), "p_name", "p_brand",
        (F.col("p_size") * F.lit(7.25)).cast("float").alias("length"),
    )
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_nationkey").cast("bigint").alias("place"), "n_name", "r_name"
    )
    place = F.col("place")
    is_play = F.col("event_type").isin(PLAY_TYPES)
    joined = events.join(songs, "song_no", "left").join(places, "place", "left")
    return joined.select(
        "event_id",
        "k",
        "event_type",
        is_play.alias("is_play"),
        F.col("ts_ms").alias("ts"),
        F.floor((F.col("ts_ms") - _NEW_YEAR_MS) / 86_400_000).cast("int").alias("sessionId"),
        (F.col("event_id") % 2147483647).cast("int").alias("itemInSession"),
        F.when(F.col("k") != 97, user).cast("int").alias("userId"),
        F.when(is_play, "NextSong").when(F.col("event_type") == "signup", "Home")
        .otherwise("Error").alias("page"),
        F.when(is_play, F.col("p_brand")).alias("artist"),
        F.when(is_play & (F.col("k") != 42), F.col("p_name")).alias("song"),
        F.when(is_play, F.col("length")).alias("duration"),
        F.col("r_name").alias("city"),
        F.lpad(place.cast("string"), 5, "0").alias("zip"),
        F.when(place != 7, F.col("n_name")).alias("state"),
        (place * 1.5 - 100).cast("float").alias("lon"),
        (place * 0.75 + 20).cast("float").alias("lat"),
        F.when(F.col("k") < 50, "agent-a").otherwise("agent-b").alias("userAgent"),
        F.when(user % 3 == 0, "F").when(user % 3 == 1, "M").alias("gender"),
        F.concat(F.lit("First"), user.cast("string")).alias("firstName"),
        F.concat(F.lit("Last"), user.cast("string")).alias("lastName"),
        (_NEW_YEAR_MS + user * 1000).alias("registration"),
        F.when(F.col("event_type") == "purchase", "paid").otherwise("free").alias("level"),
        F.lit("Logged In").alias("auth"),
        F.lit("PUT").alias("method"),
        F.lit(200).alias("status"),
        (F.col("k") >= 10).alias("success"),
    )


def _of_topic(rows: DataFrame, topic: str) -> DataFrame:
    """The rows and field variants of one topic."""
    if topic == "auth_events":
        return rows.filter(F.col("event_type") == "signup").withColumn(
            "sessionId", F.col("sessionId").cast("bigint")
        )
    if topic == "status_change_events":
        return rows.filter(F.col("event_type") == "error")
    if topic == "listen_events":
        city = F.when(F.col("k") == 59, "Elsewhere").otherwise(F.col("city"))
        return rows.filter("is_play").withColumn("city", city)
    kept = F.col("k") != 58
    return rows.withColumns({c: F.when(kept, F.col(c)) for c in ("artist", "song", "duration")})


def deliveries(described: DataFrame, topic: str) -> DataFrame:
    """Wire-typed rows of one topic (time in ms) with their delivery columns; at-least-once, so
    some arrive twice at two offsets."""
    copies = F.when(F.col("k") < 2, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = _of_topic(described, topic).withColumn("copy", F.explode(copies))
    return rows.select(
        F.lit(topic).alias("topic"),
        (F.col("event_id") % 2).cast("int").alias("partition"),
        (F.col("event_id") * 2 + F.col("copy")).alias("offset"),
        F.timestamp_millis("ts").alias("kafka_timestamp"),
        *EVENT_SCHEMAS[topic].fieldNames(),
    )


def broker_rows(described: DataFrame, topic: str) -> DataFrame:
    """The same rows as a broker hands them out: key, JSON value, topic, partition, offset, time."""
    fields = EVENT_SCHEMAS[topic].fieldNames()
    return deliveries(described, topic).select(
        F.coalesce(F.col("userId").cast("string"), F.lit("")).cast("binary").alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
        "topic", "partition", "offset",
        F.col("kafka_timestamp").alias("timestamp"),
    )


def landing_rows(described: DataFrame, topic: str) -> DataFrame:
    """The rows as the landing table holds them, without the trip through JSON and the lake."""
    rows = deliveries(described, topic).withColumn("ts", F.timestamp_millis("ts"))
    return rows.withColumn("hour", F.hour("ts"))


def read_described(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe(*(table(spark, sf_dir, n) for n in ("events", "part", "nation", "region")))
