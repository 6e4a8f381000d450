import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from cadenza.operators import dashboard, marts, quality, reports
from cadenza.sources.tables import materialise
from conftest import at, rows

RUN = "2026-11-01 00:00:00"
FACT = ("play_key string, user_id int, user_key string, song_key string, location_key string, "
        "play_started_at timestamp, listened_seconds double")
PLAYS = [
    ("p1", 1, "u1", "s1", "l1", at("10-12 08:59:00"), 120.0),
    ("p2", 2, "u2", "s1", "l1", at("10-12 08:00:00"), None),
    ("p3", 2, "u2", "s2", "l2", at("10-13 10:00:00"), 60.0),
    ("p4", 1, "u3", "s1", "l1", at("10-13 10:30:00"), 0.0),
    ("p5", None, "-1", "-1", "-1", at("10-13 23:59:59"), None),
    ("p6", 3, "u2", "s2", "l2", None, None),
]
USERS = [("u1", "F"), ("u2", "M"), ("u3", "F"), ("u4", "NB"), ("u5", ""), ("-1", "Unknown")]
SONGS = [("s1", "Shared title", "Artist A"), ("s2", "Shared title", "Artist B"),
         ("-1", "Unknown", "Unknown")]
PLACES = [("l1", " CA "), ("l2", "NY"), ("l3", "TX"), ("l4", "  "), ("-1", "Unknown")]
START, END = date(2026, 10, 12), date(2026, 10, 13)


def tables(spark, plays=PLAYS, songs=SONGS):
    fact = marts.with_audit(spark.createDataFrame(plays, FACT), RUN)
    places = spark.createDataFrame(PLACES, "location_key string, location_state string")
    users = spark.createDataFrame(USERS, "user_key string, user_gender string")
    names = spark.createDataFrame(songs, "song_key string, song_name string, song_artist_name string")
    return fact, dashboard.song_plays(fact, places, users, names), dashboard.filter_options(
        places, users
    )


@pytest.fixture(scope="module")
def board(spark):
    _, plays, options = tables(spark)
    return plays.cache(), options.cache()


def report(board, start=START, end=END, **filters):
    return reports.load_report(board[0], start, end, **filters)


def test_play_table(spark):
    fact, plays, _ = tables(spark)
    assert rows(plays, "play_key", "state", "gender", "song", "artist", "play_date", "weekday",
                "hour") == [
        ("p1", "CA", "F", "Shared title", "Artist A", START, 1, 8),
        ("p2", "CA", "M", "Shared title", "Artist A", START, 1, 8),
        ("p3", "NY", "M", "Shared title", "Artist B", END, 2, 10),
        ("p4", "CA", "F", "Shared title", "Artist A", END, 2, 10),
        ("p5", "Unknown", "Unknown", "Unknown", "Unknown", END, 2, 23),
        ("p6", "NY", "M", "Shared title", "Artist B", None, None, None),
    ]
    assert quality.dashboard_not_preserved(fact, plays).isEmpty()
    _, fanned, options = tables(spark, songs=[*SONGS, ("s1", "Copy", "Copy")])
    with pytest.raises(ValueError, match="missing or repeated keys"):
        reports.reject_bad_tables(fanned, options)
    assert rows(quality.dashboard_not_preserved(fact, fanned), "play_key", "surplus") == [
        ("p1", -1), ("p2", -1), ("p4", -1)
    ]


def test_rebuild_shows_changed_labels(spark):
    _, plays, _ = tables(spark, [(*PLAYS[0][:6], 30.5), *PLAYS[1:]], [
        ("s1", "New title", "Artist A"), *SONGS[1:]])
    assert plays.count() == 6
    assert rows(plays.filter("play_key = 'p1'"), "song", "listened_seconds") == [("New title", 30.5)]


def test_guard_and_metadata(spark, board):
    meta = reports.load_metadata(*board)
    assert rows(meta["states"]) == [("CA",), ("NY",), ("TX",), ("Unknown",)]
    assert rows(meta["genders"]) == [("F",), ("M",), ("NB",), ("Unknown",)]
    assert tuple(meta["figures"].first()) == (
        6, 1, START, END, at("11-01 00:00:00"), at("10-13 23:59:59")
    )
    with pytest.raises(ValueError, match="dashboard tables are missing"):
        reports.load_metadata(board[0], None)
    twice = board[0].unionByName(board[0].filter("play_key = 'p1'"))
    with pytest.raises(ValueError, match="missing or repeated keys"):
        reports.load_metadata(twice, board[1])


def test_full_range(board):
    found = report(board)
    assert found["summary"].first().asDict() == {
        "plays": 5, "listeners": 2, "songs": 2, "known_seconds": 180.0, "duration_missing": 2,
        "unknown_location": 1, "unknown_song": 1, "unknown_gender": 1,
    }
    assert [tuple(r) for r in found["states"].collect()] == [("CA", 3), ("NY", 1)]
    assert [tuple(r) for r in found["songs"].collect()] == [
        ("s1", "Shared title", "Artist A", 3), ("s2", "Shared title", "Artist B", 1)
    ]
    assert [tuple(r) for r in found["gender_songs"].collect()] == [
        ("F", "s1", "Shared title", "Artist A", 2), ("M", "s1", "Shared title", "Artist A", 1)
    ]
    assert [tuple(r) for r in found["artists"].collect()] == [("Artist A", 3), ("Artist B", 1)]
    cells = [tuple(r) for r in found["hourly"].collect()]
    assert [c[:2] for c in cells] == [(d, h) for d in range(1, 8) for h in range(24)]
    assert sum(c[2] for c in cells) == 5 and sum(c[3] for c in cells) == 180.0
    assert cells[8] == (1, 8, 2, 120.0, 1)
    assert [tuple(r) for r in found["daily"].collect()] == [
        (START, 2, 120 / 3600), (END, 3, 60 / 3600)
    ]


def test_filters(board):
    assert report(board, END)["summary"].first()["plays"] == 3
    chosen = report(board, END, states=["CA"], genders=["F"])["summary"].first()
    assert (chosen["plays"], chosen["known_seconds"]) == (1, 0.0)
    daily = report(board, states=["NY"])["daily"].collect()
    assert [r["plays"] for r in daily] == [0, 1]
    unknown = report(board, states=["Unknown"])["summary"].first()
    assert (unknown["plays"], unknown["duration_missing"]) == (1, 1)
    assert report(board, states=["O'Fallon"])["summary"].first()["plays"] == 0
    with pytest.raises(ValueError, match="start date"):
        report(board, END, START)


def test_empty_range(board):
    found = report(board, date(2025, 1, 1), date(2025, 1, 3))
    assert found["summary"].first()["plays"] == 0
    cells = found["hourly"].collect()
    assert len(cells) == 168 and {tuple(r)[2:] for r in cells} == {(0, 0.0, 0)}
    assert [tuple(r)[1:] for r in found["daily"].collect()] == [(0, 0.0)] * 3
    for ranking in ("states", "songs", "gender_songs", "artists"):
        assert found[ranking].isEmpty()
    assert tuple(reports.derived_figures(found["summary"]).first()) == (0, None, 0.0)
    assert tuple(reports.peak_hour(found["hourly"], found["summary"]).first()) == (1, 0, 0, None)
    assert reports.leading_songs(found["songs"], found["summary"]).isEmpty()


def test_derived_figures(board):
    found = report(board)
    assert tuple(reports.derived_figures(found["summary"]).first()) == (5, 60.0, 0.05)
    # Two cells have two plays each; the earlier one wins.
    assert tuple(reports.peak_hour(found["hourly"], found["summary"]).first()) == (1, 8, 2, 0.4)
    assert [tuple(r) for r in reports.leading_songs(found["songs"], found["summary"]).collect()] == [
        (1, "1. Shared title — Artist A", 3, 0.6), (2, "2. Shared title — Artist B", 1, 0.2)
    ]


def test_filter_reaches_the_scan(spark, board, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    board[0].write.parquet(str(tmp_path / "song_plays"))
    stored = spark.read.parquet(str(tmp_path / "song_plays"))
    plays = reports.select_plays(stored, START, END, ["CA"])
    plan = reports.top_states(plays)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "GreaterThanOrEqual(play_started_at" in scan and "LessThan(play_started_at" in scan
    assert "ReadSchema: struct<play_started_at:timestamp,state:string>" in scan


def test_stored_plays_are_pruned_by_date(spark, tmp_path):
    n = F.col("id")
    plays = spark.range(0, 4_000, 1, 8).select(
        F.sha2(n.cast("string"), 256).alias("play_key"), n.cast("int").alias("user_id"),
        F.lit("s").alias("song_key"), F.lit("l").alias("location_key"),
        F.timestamp_seconds(n * 700).alias("play_started_at"), F.lit(1.0).alias("listened_seconds"),
        *[F.lit("x").alias(c) for c in ("state", "gender", "song", "artist")],
        F.to_date(F.timestamp_seconds(n * 700)).alias("play_date"),
        F.lit(1).alias("weekday"), F.lit(1).alias("hour"),
    )
    stored = materialise(plays, str(tmp_path), "dashboard", "song_plays", day="play_date")
    assert stored.dtypes == plays.dtypes and stored.count() == 4_000
    days = list((tmp_path / "dashboard" / "song_plays").glob("rows/load=*/play_date=*"))
    files = [f for d in days for f in d.glob("*.parquet")]
    assert len(days) == 33 and len(files) == len(days)
    day = date(1970, 1, 3)
    chosen = reports.select_plays(reports.days_of(stored, day, day), day, day)
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(play_date" in plan
    assert chosen.count() == plays.where("play_date = '1970-01-03'").count() > 0


def test_bundle_equals_the_reports_one_by_one(spark, tmp_path):
    """Unknown songs, artists, users and places, ties, a key with two spellings; one scan for all."""
    pick = random.Random(7)
    plays = []
    for n in range(400):
        song = pick.choice(["s1", "s2", "s3", "s4", "-1"])
        plays.append((
            f"p{n}", pick.choice([1, 2, 3, -1, None]), song, "l",
            at(f"10-1{pick.randrange(1, 5)} {pick.randrange(10, 24)}:00:00") if n % 9 else None,
            pick.choice([None, 1.5, 0.0, 200.25]), pick.choice(["CA", "NY", "Unknown"]),
            pick.choice(["F", "M", "Unknown"]), "Title" if n % 5 else f"Title of {song}",
            "Unknown" if song == "s4" else f"Artist {song}"))
    schema = ("play_key string, user_id int, song_key string, location_key string, "
              "play_started_at timestamp, listened_seconds double, state string, gender string, "
              "song string, artist string")
    spark.createDataFrame(plays, schema).select(
        "*", F.to_date("play_started_at").alias("play_date"),
        (F.weekday("play_started_at") + 1).alias("weekday"), F.hour("play_started_at").alias("hour"),
    ).write.parquet(f"{tmp_path}/plays")
    board = spark.read.parquet(f"{tmp_path}/plays")
    kept = []

    def keep(groups):
        groups.write.parquet(f"{tmp_path}/groups{len(kept)}")
        kept.append(groups)
        return spark.read.schema(groups.schema).parquet(f"{tmp_path}/groups{len(kept) - 1}")

    for filters in ({}, {"states": ["CA"], "genders": ["F", "Unknown"]}, {"states": ["none"]}):
        bundle = reports.load_report(board, START, END, **filters, keep=keep)
        chosen = reports.select_plays(board, START, END, **filters)
        single = {
            "summary": reports.summary(chosen), "states": reports.top_states(chosen),
            "songs": reports.top_songs(chosen), "gender_songs": reports.top_song_per_gender(chosen),
            "hourly": reports.hourly_heatmap(chosen), "daily": reports.daily_trend(chosen, START, END),
            "artists": reports.top_artists(chosen),
        }
        assert list(bundle) == list(single)
        for name, df in single.items():
            assert sorted(bundle[name].columns) == sorted(df.columns)
            assert bundle[name].select(*df.columns).collect() == df.collect(), name
        table = reports.report_rows(bundle)
        counts = {r["report"]: r["count"] for r in table.groupBy("report").count().collect()}
        assert counts.pop("summary") == 8
        assert counts == {n: c for n, df in single.items() if n != "summary" and (c := df.count())}
    plan = kept[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("FileScan") == 1


def test_a_stored_verdict_is_not_counted_again(board):
    reports.reject_bad_tables(*board, sound=True)
    with pytest.raises(ValueError, match="missing or repeated keys"):
        reports.reject_bad_tables(*board, sound=False)
