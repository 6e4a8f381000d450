from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cadenza.operators import marts, quality
from cadenza.sources import versions
from cadenza.sources.tables import read_table, store_fact, table_path
from conftest import at, dec, rows

FIRST, SECOND, THIRD = "2026-11-01 00:00:00", "2026-11-02 00:00:00", "2026-11-03 00:00:00"
EPOCH = datetime(1970, 1, 1)

FACT = ("play_key string, user_id int, session_id int, item_in_session int, user_key string, "
        "song_key string, session_key string, location_key string, play_date_key date, "
        "play_time_key int, play_started_at timestamp, play_ended_at timestamp, "
        "listened_seconds double")
PLAY_1 = ("play-1", 42, 7, 0, "user-old", "song", "session", "location", date(2026, 10, 14), 28801,
          at("10-14 08:00:01.123"), at("10-14 08:00:02.373"), 1.25)
PLAY_2 = ("play-2", None, None, None, None, None, None, None, None, None,
          at("10-14 00:00:00.001"), None, None)
PLAY_3 = ("play-3", 42, 7, 5, "user-old", "song", None, None, date(2026, 10, 15), 1,
          at("10-15 00:00:01"), None, None)

SONG = "song_key string, song_name string, song_artist_name string, song_duration_seconds decimal(18,3)"
USER = ("user_key string, user_id int, user_last_name string, user_first_name string, "
        "user_gender string, registered_at timestamp, user_agent string, start_time timestamp, "
        "end_time timestamp, is_active boolean")
SESSION = ("session_key string, session_id int, user_id int, session_started_time timestamp, "
           "session_number int")


def changed(row, schema, **values):
    names = [c.split()[0] for c in schema.split(", ")]
    return tuple({**dict(zip(names, row)), **values}.values())


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def test_defaults_and_unknown_member(spark):
    songs = marts.dim_song(frame(spark, SONG, *[("song", "", None, None)] * 2), FIRST)
    assert rows(songs, "song_key", "song_name", "song_artist_name", "song_duration_seconds") == [
        ("-1", "Unknown", "Unknown", dec("-1.000")), ("song", "", "Unknown", dec("-1.000")),
    ]
    now = datetime.fromisoformat(FIRST)
    assert {tuple(r) for r in songs.select(*marts.AUDIT).collect()} == {
        (now, marts.LOADER, now, marts.LOADER)
    }

    users = marts.dim_user(
        frame(spark, USER, ("user-old", 42, None, None, None, None, None, at("10-13 00:00:00"),
                            at("10-14 00:00:00"), None),
              ("user-new", 42, "L", "F", "M", at("01-01 00:00:00"), "agent", at("10-14 00:00:00"),
               datetime(9999, 12, 1), True)), FIRST)
    assert users.count() == 3
    assert users.filter("user_key = 'user-old'").drop(*marts.AUDIT).first() == (
        "user-old", 42, "Unknown", "Unknown", "Unknown", EPOCH, "Unknown", at("10-13 00:00:00"),
        at("10-14 00:00:00"), False,
    )
    sessions = marts.dim_session(frame(spark, SESSION, ("session", None, None, None, None)), FIRST)
    assert rows(sessions.drop(*marts.AUDIT)) == [("-1", -1, -1, EPOCH, -1),
                                                ("session", -1, -1, EPOCH, -1)]


def test_unknown_time_and_date(spark):
    times = frame(spark, "time_key int, time_value string, hour_number int", (0, "00:00:00", 0))
    assert rows(marts.with_unknown(times, marts.DIM_TIME)) == [(-1, "00:00:00", -1),
                                                              (0, "00:00:00", 0)]
    days = frame(spark, "date_key date, day_name string, is_weekend boolean",
                 (date(2026, 10, 14), "Wednesday", False))
    assert rows(marts.with_unknown(days, marts.DIM_DATE)) == [
        (date(1970, 1, 1), "Unknown", False), (date(2026, 10, 14), "Wednesday", False)
    ]


@pytest.mark.parametrize(
    ("dim", "schema", "keys"),
    [(marts.DIM_SONG, SONG, ["-1", None]),
     (marts.DIM_DATE, "date_key date, day_name string", [date(1970, 1, 1), None]),
     (marts.DIM_TIME, "time_key int, time_value string", [-1, None])],
)
def test_reserved_and_missing_keys_are_refused(spark, dim, schema, keys):
    for key in keys:
        source = frame(spark, schema, (key, *[None] * (len(schema.split(", ")) - 1)))
        with pytest.raises(ValueError, match=f"Invalid or reserved dimension key: {dim.name}"):
            marts.reject_bad_keys(source, dim)
        with pytest.raises(Exception, match="Invalid or reserved dimension key"):
            marts.build_dimension(source, dim, FIRST).collect()


def test_conflicting_rows_survive_to_the_uniqueness_check(spark):
    songs = marts.dim_song(
        frame(spark, SONG, ("song", "S", None, None), ("song", "S", "Unknown", None)), FIRST
    )
    assert rows(quality.unique(songs, "song_key")) == [("song", 2)]


def test_play_key_must_be_present_and_unique(spark):
    marts.reject_bad_identity(frame(spark, FACT, PLAY_1, PLAY_2))
    marts.reject_bad_identity(frame(spark, FACT))
    for bad in (PLAY_1, changed(PLAY_1, FACT, play_key=None)):
        with pytest.raises(ValueError, match="NULL or duplicate source play_key"):
            marts.reject_bad_identity(frame(spark, FACT, PLAY_1, bad))


def test_foreign_keys_default_and_nothing_else(spark):
    found = marts.default_foreign_keys(frame(spark, FACT, PLAY_2)).first()
    assert tuple(found) == (
        "play-2", None, None, None, "-1", "-1", "-1", "-1", date(1970, 1, 1), -1,
        at("10-14 00:00:00.001"), None, None,
    )


def test_schema_change_is_refused(spark):
    fact = frame(spark, FACT, PLAY_1)
    marts.reject_schema_change(fact.schema, fact.select(*reversed(fact.columns)).schema)
    for other in (fact.withColumn("extra", F.lit(1)), fact.drop("user_id"),
                  fact.withColumn("user_id", F.col("user_id").cast("bigint"))):
        with pytest.raises(ValueError, match="schema of the stored fact"):
            marts.reject_schema_change(fact.schema, other.schema)


def audits(df):
    return {r["play_key"]: str(r["inserted_time"]) for r in df.collect()}


def test_incremental_fact(spark, tmp_path):
    warehouse = str(tmp_path)

    def run(run_ts, *plays):
        return store_fact(frame(spark, FACT, *plays), warehouse, run_ts)

    first = run(FIRST, PLAY_1, PLAY_2)
    assert audits(first) == {"play-1": FIRST, "play-2": FIRST}
    # A rerun changes nothing, not even the audit.
    assert audits(run(SECOND, PLAY_1, PLAY_2)) == {"play-1": FIRST, "play-2": FIRST}

    moved = changed(PLAY_1, FACT, user_key="user-new", listened_seconds=0.5)
    second = run(SECOND, moved, PLAY_2, PLAY_3)
    assert audits(second) == {"play-1": SECOND, "play-2": FIRST, "play-3": SECOND}
    assert second.filter("inserted_time <> updated_time").isEmpty()
    assert rows(second, "play_key", "user_key", "listened_seconds")[0] == ("play-1", "user-new", 0.5)

    # A late song and date: the row leaves the folder of the unknown date, which is then empty.
    late = changed(PLAY_2, FACT, song_key="song", play_date_key=date(2026, 10, 14))
    third = run(THIRD, moved, late, PLAY_3)
    assert audits(third) == {"play-1": SECOND, "play-2": THIRD, "play-3": SECOND}
    newest = versions.newest(spark, table_path(warehouse, "marts", "fact_song_play"))
    assert "1970-01-01" not in newest.parts[versions.ROWS]
    marts.reject_bad_identity(third)

    # A play gone at the source stays, and the check tells.
    fourth = run(THIRD, moved, late)
    assert audits(fourth) == audits(third)
    lost = quality.fact_not_preserved(frame(spark, FACT, moved, late), fourth)
    assert rows(lost, "play_key", "surplus") == [("play-3", -1)]

    with pytest.raises(ValueError, match="schema of the stored fact"):
        store_fact(frame(spark, FACT, PLAY_1).withColumn("extra", F.lit(1)), warehouse, THIRD)
    assert read_table(spark, warehouse, "marts", "fact_song_play").count() == 3


def test_stored_fact_equals_the_pure_upsert(spark, tmp_path):
    plays = [changed(PLAY_1, FACT, play_key=f"p{n}", item_in_session=n,
                     play_date_key=date(2026, 10, 1 + n % 7)) for n in range(40)]
    before = frame(spark, FACT, *plays[:30])
    after = frame(spark, FACT, *[
        changed(p, FACT, listened_seconds=2.0, play_date_key=date(2026, 10, 20)) if n % 5 == 0 else p
        for n, p in enumerate(plays[3:])
    ])
    stored = store_fact(before, str(tmp_path), FIRST)
    expected = rows(marts.fact_song_play(after, marts.fact_rows(before, FIRST), SECOND))
    assert stored.count() == 30
    assert rows(store_fact(after, str(tmp_path), SECOND)) == expected


def test_foreign_key_checks(spark):
    fact = marts.fact_rows(frame(spark, FACT, PLAY_1, PLAY_2), FIRST)
    places = frame(spark, "location_key string", ("-1",))
    assert rows(quality.relationships(fact, "location_key", places, "location_key")) == [
        ("location", 1)
    ]
