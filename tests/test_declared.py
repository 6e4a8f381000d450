"""Declared checks: a planted violation of each kind is named, tables are read once."""

import pytest
from pyspark.sql import functions as F

from cadenza.operators import declared, quality
from cadenza.plans import cycle
from cadenza.sources import tables
from conftest import rows


def checks():
    return [
        *declared._checks("song", "key name", ["key", "name artist"], {"kind": ("a", "b")}),
        *declared._checks(
            "play", "key", ["key"], refers={"song_key": ("song", "key")},
            holds={"second": "second = -1 OR second BETWEEN 0 AND 59"},
        ),
    ]


SONG, PLAY = "key string, name string, artist string, kind string", "key int, song_key string, second int"


def layer(spark, songs, plays):
    return {"song": spark.createDataFrame(songs, SONG), "play": spark.createDataFrame(plays, PLAY)}


SOUND = ([("s1", "n", None, "a"), ("s2", "n", "x", None)],
         [(1, "s1", 0), (2, "s1", -1), (3, None, None), (4, "s2", 59)])


def found(tables_):
    report = declared.report(tables_, checks())
    return {r["name"]: (r["violations"], r["example"]) for r in report.collect()}


def test_a_sound_layer(spark):
    report = found(layer(spark, *SOUND))
    assert set(report) == {c.name for c in checks()} and {n for n, _ in report.values()} == {0}
    assert declared.enforce(declared.report(layer(spark, *SOUND), checks())) == []


@pytest.mark.parametrize(
    ("songs", "plays", "name", "outcome"),
    [
        ([("s3", None, None, "a")], [], "song.name not_null", (1, None)),
        ([("s1", "other", None, "a")], [], "song.key unique", (1, "s1")),
        ([("s3", "n", None, "a")], [], "song.name+artist unique", (1, "n, NULL")),
        ([("s3", "m", None, "z")], [], "song.kind accepted_values", (1, None)),
        ([], [(5, "s9", 1), (6, "s9", 1), (7, "s8", 1)], "play.song_key relationships", (2, "s8")),
        ([], [(8, "s1", 60)], "play.second expression_is_true", (1, None)),
    ],
)
def test_each_kind_is_named(spark, songs, plays, name, outcome):
    tables_ = layer(spark, SOUND[0] + songs, SOUND[1] + plays)
    report = found(tables_)
    assert report.pop(name) == outcome and {n for n, _ in report.values()} == {0}
    with pytest.raises(quality.CheckFailed, match=f"^{name.replace('+', '.')}: {outcome[0]}$"):
        declared.enforce(declared.report(tables_, checks()))
    assert declared.enforce(declared.report(tables_, checks()), [name]) == [name]


def test_keys_without_any_value_are_not_compared(spark):
    tables_ = layer(spark, [(None, None, None, "a")] * 3, [(None, None, 1)] * 2)
    report = found(tables_)
    assert report["song.key unique"] == report["song.name+artist unique"] == (0, None)
    assert report["play.song_key relationships"] == (0, None) and report["song.key not_null"][0] == 3


def test_all_tables_at_once_all_violations_named(spark):
    tables_ = layer(spark, SOUND[0] * 2, [(1, "s9", 77)])
    with pytest.raises(quality.CheckFailed) as failed:
        declared.enforce(declared.report(tables_, checks()))
    assert str(failed.value).split("; ") == [
        "play.second expression_is_true: 1", "play.song_key relationships: 1", "song.key unique: 2",
        "song.name+artist unique: 2",
    ]


def test_empty_tables(spark):
    assert {n for n, _ in found(layer(spark, [], [])).values()} == {0}


def test_one_scan_for_each_table(spark, tmp_path):
    stored = {}
    for name, df in layer(spark, *SOUND).items():
        df.write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.parquet(f"{tmp_path}/{name}")
    plan = declared.key_checks(stored, checks())._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("FileScan") == 2


def test_writes_count_the_checks_of_their_rows(spark, tmp_path):
    warehouse = str(tmp_path)
    songs = spark.createDataFrame(SOUND[0] + [("s3", None, None, "z")], SONG)
    watch = declared.row_checks(checks(), "song")
    tables.materialise(songs, warehouse, "layer", "song", watch=watch)
    seen = tables.watched(spark, warehouse, "layer", "song")
    assert seen == {"song.key not_null": 0, "song.name not_null": 1, "song.kind accepted_values": 1}
    assert rows(declared.watched_checks(spark, seen), "name", "violations")[2] == (
        "song.name not_null", 1)


def test_every_declared_table_and_column_is_built(spark):
    from cadenza.plans.registered import Source
    from conftest import TINY

    source = Source(spark, TINY)
    for layer_name, declarations in cycle.LAYERS.items():
        built = source.layer(layer_name)
        for check in declarations:
            assert set(check.columns) <= set(built[check.table].columns), check.name
            if check.kind == declared.REFERENCE:
                assert check.what[1] in built[check.what[0]].columns
    counts = {n: len(c) for n, c in cycle.LAYERS.items()}
    assert counts["intermediate"] > 60 and counts["marts"] > 80 and counts["dashboard"] > 10


def test_checks_of_a_layer_are_stored_before_they_stop(spark, tmp_path, monkeypatch):
    warehouse = str(tmp_path)
    monkeypatch.setitem(cycle.LAYERS, "layer", checks())
    made = {
        n: cycle._checked(df, warehouse, "layer", n)
        for n, df in layer(spark, SOUND[0] + [("s1", None, None, "a")], SOUND[1]).items()
    }
    bad = made["play"].filter(F.col("second") == 59)
    tolerated = ["song.name not_null", "song.key unique"]
    with pytest.raises(quality.CheckFailed, match="^odd seconds: 1$"):
        cycle.check_layer(made, warehouse, "layer", {"odd seconds": bad}, tolerated)
    stored = tables.read_table(spark, warehouse, "layer", "checks")
    assert rows(stored.filter("violations > 0"), "name", "violations") == [
        ("odd seconds", 1), ("song.key unique", 1), ("song.name not_null", 1)]
    cycle.check_layer(made, warehouse, "layer", {"odd seconds": bad}, [*tolerated, "odd seconds"])
