"""Staging and user history extended load by load equal the rebuild from all loads."""

import random
from datetime import datetime, timedelta

import pytest
from cadenza.operators import history, staging
from cadenza.schemas import TOPICS
from cadenza.sources import increments, landing, versions
from conftest import rows

START = datetime(2026, 1, 1)
COLUMNS = ["offset", "ts", "userId", "sessionId", "lastName", "gender", "userAgent"]


class Loads:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.n = spark, folder, 0
        self.warehouse = str(folder / "warehouse")

    def add(self, topic, *events):
        """One load: (offset, ts, userId, sessionId, lastName, gender, userAgent)."""
        self.n += 1
        schema = landing.wire_schema(topic)
        names = [f.name for f in schema]
        full = [tuple(dict(zip(COLUMNS, e)).get(n) for n in names) for e in events]
        path = self.folder / f"in{self.n}"
        self.spark.createDataFrame(full, schema).coalesce(1).write.parquet(str(path))
        files = [{"uri": str(f), "file_path": str(f)} for f in path.glob("*.parquet")]
        return landing.load_files(self.spark, self.warehouse, topic, files)

    def rebuilt(self):
        stg = {
            t: staging.stage(landing.landing_table(self.spark, self.warehouse, t), t) for t in TOPICS
        }
        return stg, history.int_dim_user(*(stg[t] for t in TOPICS))

    def extend(self, *topics):
        for t in topics or TOPICS:
            increments.extend_staging(self.spark, self.warehouse, t)
        return increments.extend_history(self.spark, self.warehouse)


@pytest.fixture
def loads(spark, tmp_path):
    return Loads(spark, tmp_path)


def second(n):
    return START + timedelta(seconds=n)


def spoil(loads, table, part, keys=lambda key: True):
    """Make stored folders unreadable: whoever opens them fails."""
    path = f"{loads.warehouse}/{table}"
    folders = versions.newest(loads.spark, path).parts[part]
    for key, folder in folders.items():
        if keys(key):
            for file in (loads.folder / "warehouse" / table / part / folder).glob("*.parquet"):
                file.write_bytes(b"spoiled")


def test_a_repeat_across_loads_is_found_without_reading_old_rows(spark, loads):
    day = 86_400
    first = [(n, second(n * 7000), n % 4, 1, "L", "F", "a") for n in range(40)]
    first += [(90, None, 1, 1, "L", "F", "a"), first[3]]
    loads.add("listen_events", *first)
    increments.extend_staging(spark, loads.warehouse, "listen_events")
    # Delivered again at other offsets, beside new rows of old and new days.
    again = [(200 + n, *first[n][1:]) for n in (0, 5, 39)] + [(290, None, 1, 1, "L", "F", "a")]
    new = [(300 + n, second(n * day), 9, 2, "N", None, None) for n in range(5)]
    loads.add("listen_events", *again, *new, *new[:2])
    days = {str(d.date()) for _, d, *_ in again + new if d} | {versions.NO_DAY}
    path = f"{loads.warehouse}/staging/stg_listen_events"
    known = increments._known(spark, path, versions.newest(spark, path), list(days))
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<_one:bigint,_two:bigint>" in plan
    spoil(loads, "staging/stg_listen_events", versions.ROWS, lambda key: key.split("@")[0] not in days)
    increments.extend_staging(spark, loads.warehouse, "listen_events")
    assert increments.staged(spark, loads.warehouse, "listen_events", after=1).count() == 5
    base = versions.newest(spark, f"{loads.warehouse}/staging/stg_listen_events")
    assert base.notes["load"] == 2 and {increments.load_of(k) for k in base.parts[versions.ROWS]} == {1, 2}


def test_staging_of_many_loads_equals_the_full_distinct(spark, loads, monkeypatch):
    monkeypatch.setattr(increments, "MOST_FOLDERS", 1)
    pick = random.Random(3)
    for n in range(2):
        events = [(pick.randrange(10**6), None if pick.random() < 0.1 else second(pick.randrange(9) * 20_000),
                   pick.choice([1, None]), 1, "L", pick.choice("FM"), None) for _ in range(30)]
        loads.add("auth_events", *events)
        increments.extend_staging(spark, loads.warehouse, "auth_events")
    before = versions.numbers(spark, f"{loads.warehouse}/staging/stg_auth_events")
    found = increments.extend_staging(spark, loads.warehouse, "auth_events")
    assert versions.numbers(spark, f"{loads.warehouse}/staging/stg_auth_events") == before
    assert rows(found) == rows(loads.rebuilt()[0]["auth_events"])
    assert increments.extend_staging(spark, loads.warehouse, "listen_events").isEmpty()


def seen(n, user, name, agent="a"):
    return (n, None if n is None else second(n), user, 1, name, "F", agent)


def test_history_goes_on_without_its_observations(spark, loads):
    loads.add("auth_events", *[seen(n * 100, 1, "A" if n < 5 else "B") for n in range(8)], seen(50, 2, "C"))
    loads.add("listen_events", *[seen(n * 90, 1, "A" if n < 5 else "B") for n in range(7)])
    loads.extend()
    # Later ones only: the same state, a change, a change back, a new user, a user not seen again.
    loads.add("listen_events", seen(900, 1, "B"), seen(1000, 1, "A"), seen(1100, 1, "B"), seen(5, 3, "D"))
    spoil(loads, "intermediate/user_history", increments.OBSERVATIONS)
    found = loads.extend()
    wanted = loads.rebuilt()[1]
    assert rows(found) == rows(wanted.select(*found.columns)) and found.count() == 6
    assert rows(increments.extend_history(spark, loads.warehouse)) == rows(found)


def test_a_late_row_splits_a_version(spark, loads):
    loads.add("auth_events", seen(0, 1, "A"), seen(500, 1, "A"), seen(1000, 1, "B"), seen(0, 2, "X"))
    loads.extend("auth_events")
    loads.add("auth_events", seen(300, 1, "Z"), seen(2000, 2, "Y"))
    found = loads.extend("auth_events")
    assert rows(found.filter("user_id = 1"), "start_time", "user_last_name") == [
        (second(0), "A"), (second(300), "Z"), (second(500), "A"), (second(1000), "B")]
    assert rows(found) == rows(loads.rebuilt()[1].select(*found.columns))


def test_random_loads_equal_the_rebuild(spark, loads):
    """Ties with the last time, missing times and users, states that come back."""
    pick = random.Random(8)
    for n in range(3):
        for topic in ("auth_events", "status_change_events"):
            events = [
                (pick.randrange(10**6),
                 None if pick.random() < 0.03 else second(pick.randrange(n * 400, n * 500 + 400, 50)),
                 pick.choice([1, 2, 3, 4, 5, 6, None]), 1, pick.choice("AB"), "F", "a")
                for _ in range(14)
            ]
            loads.add(topic, *events)
        found = loads.extend("auth_events", "status_change_events")
    wanted = loads.rebuilt()[1].select(*found.columns)
    assert rows(found) == rows(wanted)


def test_a_run_that_dies_is_done_again(spark, loads, monkeypatch):
    loads.add("auth_events", seen(0, 1, "A"), seen(10, 2, "B"))
    loads.extend("auth_events")
    loads.add("auth_events", seen(20, 1, "C"), seen(5, 2, "D"))
    with monkeypatch.context() as patched:
        patched.setattr(versions.paths, "put_new", lambda *_: False)
        with pytest.raises(versions.ConcurrentRun):
            loads.extend("auth_events")
    assert increments.staged_load(spark, loads.warehouse, "auth_events") == 1
    found = loads.extend("auth_events")
    assert rows(found) == rows(loads.rebuilt()[1].select(*found.columns))
