import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from cadenza.operators import fact, history, quality
from cadenza.operators.ordered import Chunks, chunk_seconds_for, chunks_for, with_chunk
from conftest import at, dec, rows

PAGE = ("ts timestamp, sessionId int, page string, itemInSession int, city string, zip string, "
        "state string, lon decimal(18,3), lat decimal(18,3), userId int, artist string, "
        "song string, duration decimal(18,3)")
CITY = ("City", None, "ST", dec(1), dec(2))
SONG = ("Artist", "Song", dec(180))
NONE3, NONE5 = (None,) * 3, (None,) * 5

EVENTS = {
    "42/0": (at("10-13 08:00:00.123"), 7, "NextSong", 0, *CITY, 42, *SONG),
    "home": (at("10-13 08:01:00.123"), 7, "Home", 1, *CITY, 42, *NONE3),
    "42/2": (at("10-13 08:02:00.123"), 7, "NextSong", 2, *CITY, 42, *SONG),
    "99/0": (at("10-13 08:04:00.123"), 9, "NextSong", 0, "Missing", None, None, None, None, 99,
             "Other", "Missing", dec(100)),
    "42/3": (at("10-14 08:00:00.123"), 7, "NextSong", 3, *NONE5, 42, None, "Nullable", None),
}
FOREVER = datetime(9999, 12, 1)


def changed(event, **values):
    names = [c.split()[0] for c in PAGE.split(", ")]
    row = dict(zip(names, event))
    return tuple({**row, **values}.values())


@pytest.fixture(scope="module")
def dims(spark):
    def twice(data, schema):
        return spark.createDataFrame([*data, *data], schema)

    return {
        "dates": twice([(date(2026, 10, 13),)], "date_key date"),
        "times": twice([(28800,), (28920,)], "time_key int"),
        "users": twice(
            [("user-old", 42, at("10-13 00:00:00"), at("10-13 08:02:00.123")),
             ("user-new", 42, at("10-13 08:02:00.123"), FOREVER)],
            "user_key string, user_id int, start_time timestamp, end_time timestamp",
        ),
        "songs": twice(
            [("song-existing", *SONG), ("song-null", None, "Nullable", None)],
            "song_key string, song_artist_name string, song_name string, "
            "song_duration_seconds decimal(18,3)",
        ),
        "locations": twice(
            [("location-existing", *CITY), ("location-null", *NONE5)],
            "location_key string, location_city string, location_zip string, "
            "location_state string, location_lon decimal(18,3), location_lat decimal(18,3)",
        ),
        "sessions": twice(
            [("session-event-0", 42, 7, at("10-13 08:00:00.123"), 0),
             ("session-event-2", 42, 7, at("10-13 08:02:00.123"), 2),
             ("wrong-position", 42, 7, at("10-13 08:00:00.123"), 9),
             ("wrong-time", 42, 7, at("10-13 08:00:01.123"), 0),
             ("wrong-user", 43, 7, at("10-13 08:00:00.123"), 0),
             ("wrong-session", 42, 8, at("10-13 08:00:00.123"), 0)],
            "session_key string, user_id int, session_id int, session_started_time timestamp, "
            "session_number int",
        ),
    }


def build(spark, dims, events, listens=None, **options):
    """The fact, run once and held as plain rows."""
    page_view = spark.createDataFrame(list(events), PAGE)
    listen = page_view.filter("page = 'NextSong'") if listens is None else \
        spark.createDataFrame(list(listens), PAGE)
    result = fact.int_fact_song_play(listen, page_view, **dims, **options)
    return spark.createDataFrame(result.collect(), result.schema)


def plays(df):
    return {(r["user_id"], r["item_in_session"]): r for r in df.collect()}


@pytest.mark.parametrize("options", [{}, {"disjoint": False}, {"seconds": 60}])
def test_lookups(spark, dims, options):
    result = build(spark, dims, EVENTS.values(), **options)
    assert result.columns == fact.FACT_COLUMNS
    found = plays(result)
    day = date(2026, 10, 13)
    expected = {
        (42, 0): ("user-old", "song-existing", "session-event-0", "location-existing", day, 28800,
                  at("10-13 08:01:00.123"), 60.0),
        (42, 2): ("user-new", "song-existing", "session-event-2", "location-existing", day, 28920,
                  at("10-14 08:00:00.123"), 86280.0),
        (42, 3): ("user-new", "song-null", None, "location-null", None, 28800, None, None),
        (99, 0): (None, None, None, None, day, None, None, None),
    }
    columns = ["user_key", "song_key", "session_key", "location_key", "play_date_key",
               "play_time_key", "play_ended_at", "listened_seconds"]
    assert {k: tuple(r[c] for c in columns) for k, r in found.items()} == expected
    assert len({r["play_key"] for r in found.values()}) == 4
    assert quality.missing_dimensions(result).first() == (4, 1, 1, 2, 1, 1, 1)


def test_late_events(spark, dims):
    events = [
        EVENTS["42/0"], EVENTS["home"], EVENTS["99/0"], EVENTS["42/3"],
        changed(EVENTS["42/0"], ts=at("10-13 08:00:01.373"), itemInSession=100, page="Home"),
        changed(EVENTS["42/3"], itemInSession=4, page="Home"),
        changed(EVENTS["99/0"], userId=98, ts=at("10-13 08:05:00"), page="Home"),
        changed(EVENTS["99/0"], sessionId=10, ts=at("10-13 08:05:00"), page="Home"),
    ]
    listens = [EVENTS[k] for k in ("42/0", "42/2", "99/0", "42/3")]
    before = build(spark, dims, EVENTS.values())
    assert rows(build(spark, dims, EVENTS.values())) == rows(before)
    before, after = plays(before), plays(build(spark, dims, events, listens))
    assert {k: (r["play_ended_at"], r["listened_seconds"]) for k, r in after.items()} == {
        (42, 0): (at("10-13 08:00:01.373"), 1.25),
        (42, 2): (at("10-14 08:00:00.123"), 86280.0),
        (42, 3): (at("10-14 08:00:00.123"), 0.0),
        (99, 0): (None, None),
    }
    assert {k: r["play_key"] for k, r in after.items()} == {
        k: r["play_key"] for k, r in before.items()
    }


def test_conflicting_times_are_refused(spark):
    moved = changed(EVENTS["42/0"], ts=at("10-13 08:00:01.123"))
    sound = spark.createDataFrame(list(EVENTS.values()), PAGE)
    fact.reject_conflicts(fact.event_ids(sound, sound))
    with pytest.raises(ValueError, match="Conflicting event timestamps in play timeline"):
        fact.reject_conflicts(fact.event_ids(sound, spark.createDataFrame([moved], PAGE)))


def test_ambiguous_lookups_fan_out_and_are_found(spark, dims):
    song = dims["songs"].limit(1).withColumn("song_key", F.lit("song-copy"))
    result = build(spark, {**dims, "songs": dims["songs"].unionByName(song)}, EVENTS.values())
    assert rows(quality.unique(result, "play_key"), "n") == [(2,), (2,)]

    overlap = dims["users"].limit(1).withColumns(
        {"user_key": F.lit("user-overlap"), "start_time": F.lit(at("10-12 00:00:00")),
         "end_time": F.lit(FOREVER)}
    )
    users = dims["users"].unionByName(overlap)
    assert rows(fact.overlapping_periods(users), "user_key") == [("user-overlap",)]
    result = build(spark, {**dims, "users": users}, EVENTS.values())
    assert rows(quality.unique(result, "play_key"), "n") == [(2,), (2,), (2,)]

    other = changed(EVENTS["42/0"], song="Another")
    result = build(spark, dims, EVENTS.values(),
                   [*(e for e in EVENTS.values() if e[2] == "NextSong"), other])
    assert rows(quality.unique(result, "play_key"), "n") == [(2,)]


def random_events(seed=3):
    """One session owns a third; ties on time, repeats, missing users, sessions, items, times."""
    pick = random.Random(seed)
    start = datetime(2026, 1, 1)
    events = []
    for n in range(600):
        user, session = (1, 1) if n % 3 == 0 else (pick.choice([1, 2, 3, None]),
                                                  pick.choice([1, 2, None]))
        ts = start + timedelta(seconds=pick.choice([0, 5, 5, 700, 3599, 3600]) * pick.randint(0, 60))
        events.append((user, session, None if pick.random() < 0.03 else ts,
                       None if pick.random() < 0.05 else pick.randint(0, 40)))
    return list({*events})


@pytest.mark.parametrize("seconds", [60, 3600, 10_000_000])
def test_next_event_in_chunks_equals_one_pass(spark, seconds):
    events = random_events()
    expected = {}
    last = datetime.max
    for group in {e[:2] for e in events}:
        line = sorted((e for e in events if e[:2] == group),
                      key=lambda e: (e[2] or last, e[3] is None, e[3] or 0))
        for here, following in zip(line, [*line[1:], None]):
            expected[here] = following[2] if following else None
    df = spark.createDataFrame(
        events, "userId int, sessionId int, ts timestamp, itemInSession int"
    ).repartition(5)
    found = {tuple(r)[:4]: r["play_ended_at"] for r in fact.next_event(df, seconds).collect()}
    assert found == expected

    # As plays, an event finds its end only by four present ids; a repeat changes nothing.
    for known_only in (False, True):
        instants = fact.session_instants(df.unionByName(df), seconds, known_only)
        ended = fact.attach_end_time(df, instants)
        assert {tuple(r)[:4]: r["play_ended_at"] for r in ended.collect()} == {
            k: None if None in k else v for k, v in expected.items()
        }


@pytest.mark.parametrize("seconds", [60, 3600, 10_000_000])
def test_version_lookup_equals_interval_join(spark, seconds):
    """Gaps between periods, empty periods, plays on bounds, before and after all of them."""
    pick = random.Random(11)
    start = datetime(2026, 1, 1)
    versions, times = [], []
    for user in (1, 2, 3):
        now = start
        for n in range(80 if user == 1 else 5):
            now += timedelta(seconds=pick.choice([0, 30, 4000, 200000]))
            end = now + timedelta(seconds=pick.choice([0, 30, 4000, 200000]))
            versions.append((f"{user}-{n}", user, now, end))
            times += [now, end, now - timedelta(microseconds=1), now + timedelta(seconds=10)]
            now = end
        versions.append((f"{user}-last", user, now, FOREVER))
    listens = [(pick.choice([1, 1, 2, 3, 4, None]), 1, None if n % 50 == 0 else pick.choice(times), n)
               for n in range(900)]
    users = spark.createDataFrame(
        versions, "user_key string, user_id int, start_time timestamp, end_time timestamp"
    )
    df = spark.createDataFrame(
        listens, "userId int, sessionId int, ts timestamp, itemInSession int"
    ).repartition(5)
    assert fact.overlapping_periods(users, seconds).isEmpty()
    merged = fact.attach_user(df, users, seconds=seconds)
    joined = fact.attach_user(df, users, disjoint=False)
    assert merged.columns == joined.columns
    assert rows(merged) == rows(joined)
    assert merged.filter("user_key is not null").count() > 300


def test_aligned_intervals_cover_a_period_once(spark):
    pick = random.Random(5)
    start = datetime(2026, 1, 1)
    periods = []
    for n in range(60):
        begin = start + timedelta(microseconds=pick.randrange(0, 400_000_000))
        periods.append((f"k{n}", n, begin, begin + timedelta(microseconds=pick.randrange(1, 300_000_000))))
    users = spark.createDataFrame(
        periods, "user_key string, user_id int, start_time timestamp, end_time timestamp")
    first = int((datetime(2026, 1, 1) - datetime(1, 1, 1)).total_seconds())
    covered = {}
    for r in fact._aligned(users).collect():
        seconds = range(r["_number"] << r["_level"], (r["_number"] + 1) << r["_level"])
        covered.setdefault(r["userId"], []).extend(s - first for s in seconds)
    for _, user, begin, end in periods:
        low = int((begin - start).total_seconds())
        high = -int(-((end - start) / timedelta(seconds=1)) // 1)
        assert sorted(covered[user]) == list(range(low, high))


def test_overlapping_versions_are_all_found(spark):
    """Nested, crossing, equal, empty and open periods, bounds to the microsecond; repeated plays."""
    pick = random.Random(12)
    start = datetime(2026, 1, 1)
    users, times = [], []
    for n in range(150):
        begin = start + timedelta(microseconds=pick.choice([0, 1, 999_999, 1_000_000, 7_300_001]) * pick.randrange(40))
        end = pick.choice([begin, begin + timedelta(microseconds=1), begin + timedelta(seconds=pick.randrange(90)), FOREVER])
        users.append((f"k{n}", pick.choice([1, 1, 2, None]), begin, end))
        times += [begin, begin - timedelta(microseconds=1), end if end != FOREVER else begin]
    plays_ = [(pick.choice([1, 2, 3, None]), 1, pick.choice([*times, None]), n // 2) for n in range(400)]
    plays_ += plays_[:30]
    wanted = []
    for p in plays_:
        keys = [k for k, u, b, e in users if u is not None and u == p[0] and p[2] and b <= p[2] < e]
        wanted += [(*p, k) for k in keys or [None]]
    df = spark.createDataFrame(plays_, "userId int, sessionId int, ts timestamp, itemInSession int")
    versions = spark.createDataFrame(
        users, "user_key string, user_id int, start_time timestamp, end_time timestamp")
    found = fact.attach_user(df, versions.unionByName(versions.limit(9)), disjoint=False)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert rows(found) == sorted(wanted, key=key)
    nobody = fact.attach_user(df, versions.limit(0), disjoint=False)
    assert nobody.count() == len(plays_) and nobody.filter("user_key is not null").isEmpty()


def test_a_user_with_very_many_overlapping_versions(spark):
    n = F.col("id")
    users = spark.range(100_000).select(
        n.cast("string").alias("user_key"), F.lit(1).alias("user_id"),
        F.timestamp_seconds(n).alias("start_time"), F.timestamp_seconds(n + 20).alias("end_time"),
    )
    listens = spark.range(2000).select(
        F.lit(1).alias("userId"), F.lit(1).alias("sessionId"), F.timestamp_seconds(n * 50).alias("ts"),
        n.cast("int").alias("itemInSession"),
    )
    found = fact.attach_user(listens, users, disjoint=False)
    per_play = found.groupBy("itemInSession").agg(
        F.count("user_key").alias("n"), F.max(F.col("user_key").cast("int")).alias("last"))
    assert rows(per_play.filter("itemInSession > 0").groupBy("n").count()) == [(20, 1999)]
    assert per_play.filter(F.col("last") != F.col("itemInSession") * 50).isEmpty()
    # Only equal keys meet: the plan has no join on the user alone.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert all("_number" in line for line in plan.splitlines() if "Join Inner" in line)


def kept(cuts):
    return cuts.sparkSession.createDataFrame(cuts.collect(), cuts.schema)


def test_a_burst_is_cut_in_time_order(spark):
    """A third of all events by one user, another third without one, within the same minute."""
    n = F.col("id")
    events = spark.range(6000).select(
        F.when(n % 3 == 0, 7).when(n % 3 == 1, 100 + n % 50).cast("int").alias("userId"),
        F.lit(1).alias("sessionId"),
        F.timestamp_micros(n * 9000 + 1_767_225_600_000_000).alias("ts"), n.cast("int").alias("itemInSession"),
    )
    chunks = chunks_for(events, "userId", "ts", 3600, kept, most=100)
    sizes = with_chunk(events, "ts", chunks).groupBy("userId", "_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= 200
    assert {r[0] for r in chunks.splits.select("_who").collect()} == {7, None}
    order = Window.partitionBy("userId").orderBy("ts")
    numbered = with_chunk(events, "ts", chunks).withColumn("before", F.lag("_chunk").over(order))
    assert numbered.filter(F.col("before") > F.col("_chunk")).isEmpty()
    assert chunks_for(events, "userId", "ts", 3600, kept).splits is None
    for cut in (chunks, Chunks(3600, chunks.splits, few=False)):
        assert rows(fact.next_event(events, cut)) == rows(fact.next_event(events, 10_000_000))


def test_cut_chunks_give_the_same_results(spark):
    events = spark.createDataFrame(
        random_events(), "userId int, sessionId int, ts timestamp, itemInSession int").repartition(3)
    chunks = chunks_for(events, "userId", "ts", 100_000, kept, most=20)
    assert chunks.splits.count() > 3
    assert rows(fact.next_event(events, chunks)) == rows(fact.next_event(events))
    instants = fact.session_instants(events, chunks, known_only=True)
    plain = fact.session_instants(events, known_only=True)
    assert rows(fact.attach_end_time(events, instants)) == rows(fact.attach_end_time(events, plain))
    seen = events.select(
        "ts", F.col("userId").alias("user_id"), *[F.lit(None).cast("string").alias(c)
        for c in history.USER_ATTRIBUTES[:3]], (F.col("itemInSession") % 3).cast("string").alias("user_agent"),
        F.lit(None).cast("timestamp").alias("registered_at"),
    ).dropna(subset=["user_id"])
    for build in (history.change_flags, history.version_numbers, history.effective_periods):
        assert rows(build(seen, seconds=chunks)) == rows(build(seen))
    users = history.keyed_periods(history.effective_periods(seen)).filter("start_time < end_time")
    assert rows(fact.attach_user(events, users, True, chunks)) == rows(fact.attach_user(events, users, True))


def test_chunk_width_follows_the_data(spark):
    hour = spark.range(3600).select(F.timestamp_seconds("id").alias("ts"))
    assert chunk_seconds_for(hour) == 86_400
    assert chunk_seconds_for(hour.limit(0)) == 3600
