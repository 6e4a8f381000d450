import random
import re
from datetime import date, datetime, timedelta

import pytest
from cadenza.operators import dimensions, history
from conftest import at, rows


def test_time_dimension(spark):
    times = ["10-14 00:00:00", "10-14 08:00:01.001", "10-14 08:00:01.999", "10-15 08:00:01.001",
             "10-14 23:59:59.999"]
    listen = spark.createDataFrame([(at(t),) for t in times], "ts timestamp")
    found = rows(
        dimensions.int_dim_time(listen), "time_key", "time_value", "second_of_day", "second_number"
    )
    assert sorted(found) == [
        (0, "00:00:00", 0, 0), (28801, "08:00:01", 28801, 1), (86399, "23:59:59", 86399, 59),
    ]
    labels = rows(dimensions.int_dim_time(listen), "hour_12", "am_pm", "time_period")
    assert sorted(labels) == [(8, "AM", "Morning"), (11, "PM", "Night"), (12, "AM", "Night")]


def test_date_dimension_iso(spark):
    days = [datetime(2024, 12, 30, 5), datetime(2024, 12, 30, 6), datetime(2021, 1, 3)]
    listen = spark.createDataFrame([(d,) for d in days], "ts timestamp")
    assert sorted(tuple(r) for r in dimensions.int_dim_date(listen).collect()) == [
        (date(2021, 1, 3), 7, "Sunday", 3, 3, 53, 2020, 1, "January", 1, 2021, True),
        (date(2024, 12, 30), 1, "Monday", 30, 365, 1, 2025, 12, "December", 4, 2024, False),
    ]


def test_session_needs_any_song_field(spark):
    schema = ("sessionId int, userId int, ts timestamp, itemInSession int, artist string, "
              "song string, duration decimal(18,3)")
    events = [
        (1, 1, at("10-14 08:00:00"), 0, None, None, None),
        (1, 1, at("10-14 08:01:00"), 1, "A", None, None),
        (1, None, at("10-14 08:02:00"), 2, None, "S", None),
    ]
    sessions = dimensions.int_dim_session(spark.createDataFrame(events, schema))
    assert rows(sessions, "session_number") == [(1,), (2,)]


OBSERVED = ("ts timestamp, user_id int, user_last_name string, user_first_name string, "
            "user_gender string, user_agent string, registered_at timestamp")


def observation(ts, user, agent, gender="F"):
    return (ts, user, "L", "F", gender, agent, datetime(2026, 1, 1))


def brute_force(observations):
    """Numbered, flagged and versioned observations, one user at a time in plain Python."""
    last = datetime.max
    result = []
    for user in sorted({o[1] for o in observations}):
        mine = [o for o in observations if o[1] == user]
        mine.sort(key=lambda o: (o[0] or last, *((v is None, v) for v in
                                                  (o[2], o[3], o[4], o[5], o[6]))))
        version = 0
        for n, row in enumerate(mine, start=1):
            previous = mine[n - 2] if n > 1 else None
            changed = previous is None or row[2:] != previous[2:]
            version += changed
            result.append((row, n, previous, int(changed), version))
    return result


@pytest.fixture(scope="module")
def history_rows():
    """Gaps of seconds to days, ties on time, missing times and attributes, one dominant user."""
    pick = random.Random(7)
    seen = set()
    start = datetime(2026, 1, 1)
    for user, n in ((1, 400), (2, 60), (3, 1), (4, 90)):
        now = start
        for _ in range(n):
            now += timedelta(seconds=pick.choice([0, 1, 20, 900, 4000, 90000]))
            ts = None if pick.random() < 0.02 else now
            seen.add(observation(ts, user, pick.choice(["a", "a", "b", None]),
                                 pick.choice(["F", "F", "F", None])))
    return sorted(seen, key=str)


@pytest.mark.parametrize("seconds", [60, 3600, 10_000_000])
def test_history_in_chunks_equals_one_pass(spark, history_rows, seconds):
    df = spark.createDataFrame(history_rows, OBSERVED).repartition(5)
    expected = brute_force(history_rows)

    flags = history.change_flags(df, seconds=seconds)
    found = {tuple(r)[:7]: tuple(r)[7:] for r in flags.collect()}
    assert found == {
        row: (n, *(previous[2:] if previous else [None] * 5), changed)
        for row, n, previous, changed, _ in expected
    }

    numbers = history.version_numbers(df, seconds=seconds)
    assert {tuple(r)[:7]: r["version_number"] for r in numbers.collect()} == {
        row: version for row, _, _, _, version in expected
    }

    starts = [row for row, _, _, changed, _ in expected if changed]
    assert sorted(str((r["user_id"], r["start_time"], r["user_agent"], r["user_gender"]))
                  for r in history.version_starts(df, seconds=seconds).collect()) == sorted(
        str((o[1], o[0], o[5], o[4])) for o in starts
    )

    periods = {}
    for here, following in zip(starts, [*starts[1:], None]):
        same = following is not None and following[1] == here[1]
        end = following[0] if same else None
        periods.setdefault(
            str((here[1], here[0], here[5], here[4], end or datetime(9999, 12, 1), end is None)), 0
        )
    result = history.effective_periods(df, seconds=seconds)
    assert sorted(
        str((r["user_id"], r["start_time"], r["user_agent"], r["user_gender"], r["end_time"],
             r["is_active"]))
        for r in result.collect()
    ) == sorted(periods)


def test_value_that_returns_is_a_new_version(spark):
    times = [at(f"10-14 0{h}:00:00") for h in range(4)]
    df = spark.createDataFrame(
        [observation(t, 1, a) for t, a in zip(times, "abba")], OBSERVED
    )
    periods = history.effective_periods(df)
    assert rows(periods, "user_agent", "start_time", "end_time", "is_active") == [
        ("a", times[0], times[1], False),
        ("a", times[3], datetime(9999, 12, 1), True),
        ("b", times[1], times[3], False),
    ]


def test_no_task_sees_a_whole_user(spark):
    """Windows over observations are keyed by user and chunk; those keyed by the user alone run over
    edges, one row per chunk, in chunk order."""
    df = spark.createDataFrame([observation(at("10-14 08:00:00"), 1, "a")], OBSERVED)
    plan = history.effective_periods(df)._jdf.queryExecution().optimizedPlan().toString()
    keys = re.findall(r"Window \[.*\], \[([^\]]*)\], \[([^\]]*)\]$", plan, re.MULTILINE)
    assert len(keys) >= 4
    for partition, order in keys:
        assert "_chunk" in partition or re.fullmatch(r"_chunk#\d+L (ASC|DESC) NULLS (FIRST|LAST)", order)
