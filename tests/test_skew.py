"""Hot keys: a third of the plays share one song, one user and the Unknown member."""

import pytest
from pyspark.sql import functions as F

from cadenza.operators import dashboard, fact, history

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture()
def many_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stored(df, path):
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_hot_keys_are_split(many_partitions, tmp_path):
    spark = many_partitions
    n = F.col("id")
    hot = n % 3 == 0
    plays = stored(
        spark.range(0, 60_000, 1, 8).select(
            F.sha2(n.cast("string"), 256).alias("play_key"),
            F.when(hot, "hot").otherwise(F.concat(F.lit("a"), n % 500)).alias("artist"),
            F.lit("song").alias("song"),
            F.lit(1).cast("decimal(18,3)").alias("duration"),
            F.when(hot, "-1").otherwise(F.concat(F.lit("u"), n % 500)).alias("user_key"),
            F.concat(F.lit("l"), n % 50).alias("location_key"),
            F.lit(1).alias("user_id"),
            F.timestamp_seconds(n).alias("play_started_at"),
            F.lit(1.0).alias("listened_seconds"),
            F.timestamp_seconds(n).alias("updated_time"),
        ),
        str(tmp_path / "plays"),
    )
    songs = stored(
        plays.select("artist", "song", "duration").distinct().select(
            F.md5("artist").alias("song_key"),
            F.col("artist").alias("song_artist_name"),
            F.col("song").alias("song_name"),
            F.col("duration").alias("song_duration_seconds"),
        ),
        str(tmp_path / "songs"),
    )
    found = fact.attach_song(plays, songs)
    totals = found.agg(F.count("song_key"), F.max("play_key"))
    assert totals.first()[0] == 60_000
    assert "SortMergeJoin(skew=true)" in final_plan(totals)

    users = stored(
        plays.select("user_key").distinct().withColumn("user_gender", F.lit("F")),
        str(tmp_path / "users"),
    )
    places = stored(
        plays.select("location_key").distinct().withColumn("location_state", F.lit("ST")),
        str(tmp_path / "places"),
    )
    board = dashboard.song_plays(found, places, users, songs)
    totals = board.agg(F.count("gender"), F.max("play_key"), F.max("song"), F.max("state"))
    assert totals.first()[0] == 60_000
    plan = final_plan(totals)
    assert plan.count("SortMergeJoin(skew=true)") >= 2


def test_hot_user_is_spread_over_tasks(spark):
    """A user with a third of the plays, and as many versions, meets no task with all of them."""
    n = F.col("id")
    user = F.when(n % 3 == 0, 0).otherwise(1 + n % 997).cast("int")
    plays = spark.range(0, 30_000, 1, 4).select(
        user.alias("userId"), F.lit(1).alias("sessionId"), n.cast("int").alias("itemInSession"),
        F.timestamp_seconds(n * 60).alias("ts"),
    )
    users = plays.groupBy("userId").agg(F.sort_array(F.collect_list("ts")).alias("starts"))
    # Each play starts a version that ends a second later: all versions disjoint, each play found.
    users = users.select("userId", F.explode("starts").alias("start_time")).select(
        F.concat_ws("@", "userId", "start_time").alias("user_key"),
        F.col("userId").alias("user_id"),
        "start_time",
        (F.col("start_time") + F.expr("interval 1 second")).alias("end_time"),
    )
    found = fact.attach_user(plays, users)
    wanted = F.concat_ws("@", "userId", "ts")
    assert found.filter(F.col("user_key") == wanted).count() == 30_000
    # The hot user's plays lie in 500 hours of 20.
    hour = F.floor(F.unix_seconds("ts") / 3600)
    assert plays.groupBy("userId", hour).count().agg(F.max("count")).first()[0] == 20


def test_plays_without_a_user_are_no_hot_key(spark):
    n = F.col("id")
    plays = spark.range(30_000).select(
        F.when(n % 3 > 0, n % 700).cast("int").alias("userId"),
        F.when(n % 3 > 0, n % 900).cast("int").alias("sessionId"),
        F.timestamp_seconds(n % 3600).alias("ts"), n.cast("int").alias("itemInSession"),
        F.lit("c").alias("city"), F.lit("a").alias("artist"), F.lit("s").alias("song"),
    )
    sizes = fact._play_chunks(plays, 3600).groupBy("userId", "_chunk").count()
    assert sizes.where("userId is null").agg(F.max("count")).first()[0] < 20
    users = spark.createDataFrame(
        [("k", 1, "1970-01-01 00:10:00", "1970-01-01 00:20:00")],
        "user_key string, user_id int, start string, end string",
    ).select(
        "user_key", "user_id", F.col("start").cast("timestamp").alias("start_time"),
        F.col("end").cast("timestamp").alias("end_time"),
    )
    found = fact.attach_user(plays, users, disjoint=True)
    assert found.count() == 30_000
    inside = F.col("ts").between(F.timestamp_seconds(F.lit(600)), F.timestamp_seconds(F.lit(1199)))
    wrong = found.where(F.col("user_key").isNotNull() != F.coalesce((F.col("userId") == 1) & inside, F.lit(False)))
    assert wrong.isEmpty()


def _shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_work_on_chunks_shares_one_shuffle(many_partitions, tmp_path):
    """Copies are removed, and instants grouped, behind the shuffle that the chunks need anyway."""
    spark = many_partitions
    seen = spark.range(40).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 10 * 1800).alias("ts"),
        (F.col("id") % 3).cast("int").alias("userId"),
        F.lit("l").alias("lastName"), F.lit("f").alias("firstName"), F.lit("g").alias("gender"),
        (F.col("id") % 2).cast("string").alias("userAgent"),
        F.lit(None).cast("timestamp").alias("registration"),
        (F.col("id") % 2).cast("int").alias("sessionId"),
        F.col("id").cast("int").alias("itemInSession"),
    )
    stream = stored(seen, f"{tmp_path}/seen")
    users = history.int_dim_user(stream, stream, stream, stream)
    assert not [s for s in _shuffles(users) if "lastName" in s or "user_last_name" in s]
    plain = history.keyed_periods(
        history.effective_periods(history.user_observations(stream, stream))
    )
    assert users.exceptAll(plain).isEmpty() and plain.exceptAll(users).isEmpty()

    events = fact.event_ids(stream, stream)
    instants = fact.session_instants(events, known_only=True)
    assert not [s for s in _shuffles(instants) if "ts#" in s]
    both = fact.session_instants(events)
    assert instants.select(*both.columns).exceptAll(both).isEmpty()
    assert instants.count() == both.count()
