from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cadenza.operators import marts, quality
from conftest import at, dec, rows


def test_generic_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "z"), (None, None)],
                               "id int, kind string")
    assert quality.not_null(df, "id").count() == 2
    assert rows(quality.unique(df, "id")) == [(1, 2)]
    assert rows(quality.accepted_values(df, "kind", ["a", "b"])) == [("z", 1)]
    both = df.unionByName(df)
    # A row without any of the values is not compared.
    assert len(rows(quality.unique_together(both, ["id", "kind"]))) == 4
    assert rows(quality.expression_is_true(df, F.col("id") < 2), "id") == [(2,)]
    parent = spark.createDataFrame([(1,)], "key int")
    assert rows(quality.relationships(df, "id", parent, "key")) == [(2, 1)]
    with pytest.raises(quality.CheckFailed, match="id is unique"):
        quality.require({"kind": quality.accepted_values(df, "kind", ["a", "b", "z"]),
                         "id is unique": quality.unique(df, "id")})


def test_time_key_range(spark):
    keys = spark.createDataFrame([(-1,), (0,), (86399,), (86400,), (-2,)], "play_time_key int")
    assert rows(quality.expression_is_true(keys, quality.valid_time_key())) == [(-2,), (86400,)]


def test_durations(spark):
    start, later = at("10-14 08:00:00"), at("10-14 08:00:01.250")
    plays = [
        ("last", start, None, None), ("fractional", start, later, 1.25), ("zero", start, start, 0.0),
        ("missing_end", start, None, 1.0), ("missing_seconds", start, at("10-14 08:00:01"), None),
        ("negative", start, at("10-14 07:59:59"), -1.0), ("wrong_seconds", start, later, 1.0),
    ]
    fact = spark.createDataFrame(
        plays, "play_key string, play_started_at timestamp, play_ended_at timestamp, "
               "listened_seconds double")
    assert [r[0] for r in rows(quality.bad_durations(fact))] == [
        "missing_end", "missing_seconds", "negative", "wrong_seconds"
    ]


def test_audit(spark):
    sound = marts.with_audit(spark.range(3), "2026-11-01 00:00:00")
    broken = {
        "by": sound.withColumn("updated_by", F.lit("someone")),
        "time": sound.withColumn("updated_time", F.lit(None).cast("timestamp")),
        "order": sound.withColumn("updated_time", F.lit(datetime(2027, 1, 1))),
    }
    assert quality.bad_audit({"sound": sound}).isEmpty()
    assert rows(quality.bad_audit({"sound": sound, **broken})) == [
        ("by", 3), ("order", 3), ("time", 3)
    ]


def test_unknown_member(spark):
    schema = "time_key int, time_value string"
    source = spark.createDataFrame([(5, "00:00:05")], schema)
    sound = marts.with_unknown(source, marts.DIM_TIME)

    def problems(mart, raw=source):
        found = quality.bad_unknown_member(raw, mart, marts.DIM_TIME)
        return [r[0] for r in rows(found)]

    assert problems(sound) == []
    assert problems(source) == ["dim_time: missing/duplicate Unknown"]
    assert problems(sound.unionByName(sound.filter("time_key = -1"))) == [
        "dim_time: missing/duplicate Unknown", "dim_time: wrong defaults"
    ]
    wrong = sound.withColumn("time_value", F.lit("11:11:11"))
    assert problems(wrong) == ["dim_time: wrong defaults"]
    assert problems(sound, spark.createDataFrame([(-1, "x")], schema)) == [
        "dim_time: reserved source key"
    ]


ROWS = [
    (1, "duplicate", dec("1.25"), at("10-14 10:00:00")),
    (1, "duplicate", dec("1.25"), at("10-14 10:00:00")),
    (2, None, None, at("10-14 10:01:00")),
    (3, "", dec("0.0"), None),
    (4, "last row", dec("9.50"), at("10-14 10:02:00")),
]
SCHEMA = "id int, payload string, duration decimal(9,2), event_time timestamp"


@pytest.mark.parametrize(
    ("target", "missing", "extra"),
    [
        (ROWS, 0, 0),
        (ROWS[1:], 1, 0),
        ([*ROWS[1:], ROWS[3]], 1, 1),
        ([*ROWS[:2], (2, "x", *ROWS[2][2:]), *ROWS[3:]], 1, 1),
        ([], 5, 0),
    ],
)
def test_row_reconciliation(spark, target, missing, extra):
    found = quality.reconcile_rows(
        spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(target, SCHEMA)
    ).first()
    assert tuple(found) == (5, len(target), missing, extra, "", not missing and not extra)


def test_rows_without_any_partner_are_counted_not_compared(spark, monkeypatch):
    compared, plain = [], quality._in_unequal

    def watched(df, groups):
        compared.append(groups.filter(~F.col("equal")).count())
        return plain(df, groups)

    monkeypatch.setattr(quality, "_in_unequal", watched)
    full, none = (spark.createDataFrame(r, SCHEMA) for r in ([*ROWS, ROWS[0]], []))
    assert tuple(quality.reconcile_rows(full, none).first()) == (6, 0, 6, 0, "", False)
    assert tuple(quality.reconcile_rows(none, full).first()) == (0, 6, 0, 6, "", False)
    assert tuple(quality.reconcile_rows(none, none).first()) == (0, 0, 0, 0, "", True)
    assert compared == [0] * 6


def test_type_and_column_differences(spark):
    source = spark.createDataFrame(ROWS, SCHEMA)
    wide = source.withColumn("id", F.col("id").cast("bigint"))
    found = quality.reconcile_rows(source, wide).first()
    assert (found["schema_differences"], found["passed"]) == ("id", False)
    fewer = quality.reconcile_rows(source, source.drop("payload")).first()
    assert (fewer["missing_rows"], fewer["passed"]) == (None, False)
    more = quality.reconcile_rows(source, source.withColumn("more", F.lit(1))).first()
    assert (more["missing_rows"], more["schema_differences"], more["passed"]) == (0, "more", False)


def test_stored_year_counts_but_a_folder_does_not(spark, tmp_path):
    source = spark.createDataFrame(ROWS, SCHEMA).withColumn("year", F.lit(2026))
    changed = quality.reconcile_rows(source, source.withColumn("year", F.lit(2025))).first()
    assert (changed["missing_rows"], changed["extra_rows"]) == (5, 5)

    from cadenza.sources.landing import read_files

    folder = tmp_path / "year=2026"
    plain = source.drop("year")
    plain.coalesce(1).write.parquet(str(folder))
    files = [str(p) for p in folder.glob("*.parquet")]
    assert quality.reconcile_rows(plain, read_files(spark, files)).first()["passed"]
