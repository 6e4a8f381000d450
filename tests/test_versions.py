"""Stored tables: versions, crashes between write and switch, runs at once, fingerprints by bucket."""

import threading
from datetime import date

import pytest
from pyspark.sql import functions as F

from cadenza.operators import digests, marts
from cadenza.sources import paths, tables, versions
from conftest import rows
from test_marts import FACT, FIRST, PLAY_1, SECOND, THIRD, changed, frame


def numbered(spark, *ids):
    return spark.createDataFrame([(i, date(2026, 1, 1 + i % 3)) for i in ids], "id int, day date")


def test_a_version_is_seen_when_its_file_is_there(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    versions.replace(numbered(spark, 1, 2, 3), path, "day")
    before = rows(versions.read(spark, path))

    def die(*_):
        raise OSError("the driver is gone")

    with monkeypatch.context() as patched:
        patched.setattr(paths, "put_new", die)
        with pytest.raises(OSError, match="the driver is gone"):
            versions.replace(numbered(spark, 4), path, "day")
    assert rows(versions.read(spark, path)) == before
    versions.replace(numbered(spark, 4, 7), path, "day")
    assert rows(versions.read(spark, path), "id") == [(4,), (7,)]
    assert rows(versions.read(spark, path, days=["2026-01-02"]), "id") == [(4,), (7,)]
    assert versions.read(spark, path, days=["2026-01-01"]).isEmpty()


def test_the_version_before_stays_readable_and_older_ones_go(spark, tmp_path):
    path = str(tmp_path)
    for n in range(4):
        versions.replace(numbered(spark, n), path)
    assert versions.numbers(spark, path) == [3, 4]
    assert rows(versions.read(spark, path, versions.version(spark, path, 3)), "id") == [(2,)]
    assert len(paths.folders(spark, f"{path}/rows")) == 2


def test_of_two_runs_one_gets_the_number(spark, tmp_path):
    path = str(tmp_path)
    base = versions.replace(numbered(spark, 1), path)
    mine, _ = versions.write_part(numbered(spark, 2), path)
    versions.replace(numbered(spark, 3), path)
    with pytest.raises(versions.ConcurrentRun):
        versions.commit(spark, path, base, base.schemas, {versions.ROWS: mine})
    assert rows(versions.read(spark, path), "id") == [(3,)]

    won = []
    target = f"{path}/claim"
    tries = [
        threading.Thread(target=lambda n=n: won.append(n) if paths.put_new(spark, target, f"{n}") else None)
        for n in range(8)
    ]
    for t in tries:
        t.start()
    for t in tries:
        t.join()
    assert len(won) == 1 and paths.read_text(spark, target) == str(won[0])
    assert [n for n, _, _ in paths.listing(spark, path) if n.endswith(".tmp")] == []


def test_what_a_write_watches_is_kept(spark, tmp_path):
    df = numbered(spark, *range(10))
    watch = {"odd": F.count_if(F.col("id") % 2 == 1), "all": F.count(F.lit(1))}
    for day in (None, "day"):
        found = versions.replace(df, str(tmp_path / str(day)), day, watch)
        assert found.notes["watched"] == {"odd": 5, "all": 10}


def test_empty_rows(spark, tmp_path):
    for day in (None, "day"):
        path = str(tmp_path / str(day))
        versions.replace(numbered(spark, 1).limit(0), path, day)
        assert versions.read(spark, path).isEmpty()
        assert versions.read(spark, path).columns == ["id", "day"]
    with pytest.raises(ValueError, match="nothing is stored"):
        versions.read(spark, str(tmp_path / "nowhere"))


def plays_of(spark, *numbers, seconds=2.0, late=()):
    return frame(spark, FACT, *[
        changed(PLAY_1, FACT, play_key=f"p{n}", item_in_session=n,
                listened_seconds=9.0 if n in late else seconds, play_date_key=date(2026, 10, 1 + n % 5))
        for n in numbers
    ])


def stored_days(spark, tmp_path):
    path = tables.table_path(str(tmp_path), "marts", "fact_song_play")
    return versions.newest(spark, path).parts[versions.ROWS], path


def test_a_run_without_changes_stores_nothing(spark, tmp_path):
    tables.store_fact(plays_of(spark, *range(20)), str(tmp_path), FIRST)
    before, path = stored_days(spark, tmp_path)
    tables.store_fact(plays_of(spark, *reversed(range(20))), str(tmp_path), SECOND)
    after, _ = stored_days(spark, tmp_path)
    assert before == after and versions.numbers(spark, path) == [1]
    assert paths.folders(spark, f"{path}/aside") == []


def test_only_touched_days_are_written(spark, tmp_path):
    tables.store_fact(plays_of(spark, *range(20)), str(tmp_path), FIRST)
    before, path = stored_days(spark, tmp_path)
    found = tables.store_fact(plays_of(spark, *range(20), late=[7]), str(tmp_path), SECOND)
    after, _ = stored_days(spark, tmp_path)
    assert {d for d in before if before[d] != after[d]} == {"2026-10-03"}
    times = {r["play_key"]: str(r["inserted_time"]) for r in found.collect()}
    assert [k for k, t in times.items() if t == SECOND] == ["p7"]
    # Of that day's buckets only the one with the changed play is joined.
    known = versions.read(spark, path, versions.version(spark, path, 1), tables.DIGESTS)
    fresh = tables.fact_digests(marts.default_foreign_keys(plays_of(spark, *range(20), late=[7])))
    groups = [tables.FACT_PARTITION, digests.BUCKET]
    assert digests.compared(fresh, known, groups).filter("not equal").count() == 1


def test_a_crash_before_the_switch_keeps_all_rows(spark, tmp_path, monkeypatch):
    tables.store_fact(plays_of(spark, *range(20)), str(tmp_path), FIRST)
    path = stored_days(spark, tmp_path)[1]
    before = rows(versions.read(spark, path))
    later = plays_of(spark, *range(5, 30), late=range(5, 12))
    with monkeypatch.context() as patched:
        patched.setattr(versions.paths, "put_new", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError, match="gone"):
            tables.store_fact(later, str(tmp_path), SECOND)
    assert rows(versions.read(spark, path)) == before
    wanted = marts.fact_song_play(later, spark.createDataFrame(before, versions.read(spark, path).schema), THIRD)
    assert rows(tables.store_fact(later, str(tmp_path), THIRD)) == rows(wanted)


def test_two_runs_of_the_fact_at_once(spark, tmp_path, monkeypatch):
    """The slower one is refused: it must not put back what the faster one changed."""
    tables.store_fact(plays_of(spark, 1, 2, 3), str(tmp_path), FIRST)
    real = versions.commit

    def after_another(*args, **kwargs):
        monkeypatch.setattr(versions, "commit", real)
        tables.store_fact(plays_of(spark, 1, 2, 3, late=[1]), str(tmp_path), SECOND)
        return real(*args, **kwargs)

    monkeypatch.setattr(versions, "commit", after_another)
    with pytest.raises(versions.ConcurrentRun):
        tables.store_fact(plays_of(spark, 1, 2, 3, late=[2]), str(tmp_path), THIRD)
    path = stored_days(spark, tmp_path)[1]
    late = versions.read(spark, path).filter("listened_seconds = 9")
    assert rows(late, "play_key") == [("p1",)]


def test_fingerprints_tell_missing_values_and_copies_apart(spark):
    schema = "a int, b int, c string"
    one = [(1, None, "x"), (1, None, "x"), (2, 3, None), (None, None, None)]
    for other in (
        [(None, 1, "x"), (1, None, "x"), (2, 3, None), (None, None, None)],
        [(1, None, "x"), (2, 3, None), (2, 3, None), (None, None, None)],
        one[1:],
        [*one[:3], (None, None, "")],
    ):
        prints = [
            digests.fingerprints(spark.createDataFrame(r, schema).withColumn("g", F.lit(1)), "abc", ["g"])
            for r in (one, other)
        ]
        assert not digests.compared(*prints, ["g"]).first()["equal"]
    prints = [
        digests.fingerprints(spark.createDataFrame(r, schema).withColumn("g", F.lit(1)), "abc", ["g"])
        for r in (one, one[::-1])
    ]
    assert digests.compared(*prints, ["g"]).first()["equal"]
