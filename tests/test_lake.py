import json
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cadenza.__main__ import main, stored_dashboard
from cadenza.operators import quality, reports
from cadenza.plans.audit import audit_topic
from cadenza.plans.cycle import run_cycle
from cadenza.schemas import EVENT_SCHEMAS, TOPICS
from cadenza.sources import events, lake, landing, messages
from cadenza.sources.tables import read_table
from cadenza.streaming import kafka, sink
from cadenza.streaming.decode import decode
from conftest import TINY, rows


@pytest.fixture(scope="module")
def described(spark):
    return events.read_described(spark, TINY)


@pytest.fixture(scope="module")
def lake_dir(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stream")
    stream = events.describe(
        events.event_stream(spark, TINY),
        *(events.table(spark, TINY, n) for n in ("part", "nation", "region")),
    )
    queries = sink.start_topics(
        spark, lambda t: events.broker_rows(stream, t), f"{root}/lake", f"{root}/checkpoint",
        trigger=None,
    )
    sink.finish(queries)
    return f"{root}/lake"


def test_kafka_options():
    assert kafka.topic_options("a:9092,b:9092", "listen_events") == {
        "kafka.bootstrap.servers": "a:9092,b:9092", "subscribe": "listen_events",
        "startingOffsets": "earliest",
    }
    limited = kafka.topic_options("a:9092", "listen_events", "latest", 500)
    assert limited["startingOffsets"] == "latest" and limited["maxOffsetsPerTrigger"] == "500"


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        kafka.read_topic(spark, "nowhere:9092", "listen_events")


def test_decode_keeps_what_it_cannot_read(spark):
    values = [
        '{"ts": 1791964801123, "sessionId": 7, "level": "paid", "lon": -80.058452, "success": true}',
        "not json",
        '{"ts": 1791964801123, "sessionId": "x", "level": "free"}',
    ]
    broker = spark.createDataFrame(
        [(v.encode(), "auth_events", 0, n, datetime(2026, 10, 14)) for n, v in enumerate(values)],
        "value binary, topic string, partition int, offset bigint, timestamp timestamp",
    )
    decoded = decode(broker, EVENT_SCHEMAS["auth_events"])
    good, bad, partly = decoded.orderBy("offset").collect()
    assert decoded.columns == [
        "topic", "partition", "offset", "kafka_timestamp", "raw_json",
        *EVENT_SCHEMAS["auth_events"].fieldNames(), "year", "month", "day", "hour",
    ]
    assert good["ts"] == datetime(2026, 10, 14, 8, 0, 1, 123000)
    assert (good["year"], good["month"], good["day"], good["hour"]) == (2026, 10, 14, 8)
    assert (bad["raw_json"], bad["ts"], bad["level"], bad["year"]) == ("not json", None, None, None)
    assert (partly["sessionId"], partly["level"]) == (None, "free")


@pytest.mark.parametrize("topic", TOPICS)
def test_stream_equals_batch(spark, described, lake_dir, topic):
    streamed = spark.read.parquet(f"{lake_dir}/{topic}")
    batch = decode(events.broker_rows(described, topic), EVENT_SCHEMAS[topic])
    assert quality.reconcile_rows(batch.select(*streamed.columns), streamed).first()["passed"]
    direct = events.landing_rows(described, topic)
    assert quality.reconcile_rows(direct, streamed.select(*direct.columns)).first()["passed"]


def test_stream_again_adds_nothing(spark, lake_dir):
    before = spark.read.parquet(f"{lake_dir}/auth_events").count()
    stream = events.describe(
        events.event_stream(spark, TINY),
        *(events.table(spark, TINY, n) for n in ("part", "nation", "region")),
    )
    sink.finish(sink.start_topics(
        spark, lambda t: events.broker_rows(stream, t), lake_dir,
        lake_dir.replace("/lake", "/checkpoint"), ["auth_events"], trigger=None,
    ))
    assert spark.read.parquet(f"{lake_dir}/auth_events").count() == before


def test_the_lake_is_written_in_bounded_tasks(spark, described, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(events, "ROWS_PER_TASK", 100)
    stream = events.described_stream(spark, TINY)
    stream.explain()
    assert "SortMergeJoin" in capsys.readouterr().out
    topic = "page_view_events"
    sink.finish(
        sink.start_topics(
            spark, lambda t: events.broker_rows(stream, t), f"{tmp_path}/lake",
            f"{tmp_path}/checkpoint", topics=[topic], trigger=None,
        )
    )
    # One file of events, ten tasks; each writes the days of its own stretch of time.
    files = [(int(p.name.split("-")[1]), p.parent) for p in tmp_path.glob("lake/**/*.parquet")]
    assert len({task for task, _ in files}) >= 8
    assert len(files) <= 10 + len({day for _, day in files})
    columns = ["partition", "offset", "userId", "song"]
    written = spark.read.parquet(f"{tmp_path}/lake/{topic}")
    assert rows(written, *columns) == rows(events.deliveries(described, topic), *columns)


def test_an_interrupt_stops_every_query(spark, tmp_path, monkeypatch):
    stream = events.describe(
        events.event_stream(spark, TINY),
        *(events.table(spark, TINY, n) for n in ("part", "nation", "region")),
    )
    running = []

    def interrupt(_):
        running.extend(q.name for q in spark.streams.active)
        raise KeyboardInterrupt

    monkeypatch.setattr(type(spark.streams), "awaitAnyTermination", interrupt)
    sink.run_topics(
        spark, lambda t: events.broker_rows(stream, t), str(tmp_path / "lake"),
        str(tmp_path / "checkpoint"), topics=["auth_events", "listen_events"], trigger="1 hour",
    )
    assert sorted(running) == ["auth_events", "listen_events"]
    assert not spark.streams.active


@pytest.fixture(scope="module")
def small_lake(spark, tmp_path_factory):
    """Seven batches of one file each, in daily folders with a space in one name; the log is
    compacted every third batch."""
    root = tmp_path_factory.mktemp("small")
    key = "spark.sql.streaming.fileSink.log.compactInterval"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "3")
    for n in range(7):
        part = spark.range(n * 5, n * 5 + 5).select(
            F.col("id").alias("offset"), F.lit("a b" if n == 2 else f"d{n}").alias("day"))
        part.coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema("offset bigint, day string").option("maxFilesPerTrigger", 1)
    query = (
        stream.parquet(f"{root}/in").writeStream.format("parquet").partitionBy("day")
        .option("path", f"{root}/lake/t").option("checkpointLocation", f"{root}/check")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    return root / "lake"


def test_committed_files(spark, small_lake, tmp_path):
    folder = small_lake / "t"
    assert any(f.name.endswith(".compact") for f in (folder / lake.LOG_DIR).iterdir())
    # Files of a batch that never ended lie there, but are not committed.
    stray = next(folder.glob("day=d0/*.parquet"))
    (folder / "day=d0" / "stray.parquet").write_bytes(stray.read_bytes())
    found = lake.committed_files(spark, str(folder), "t")
    there = {str(f) for f in folder.glob("day=*/*.parquet") if f.name != "stray.parquet"}
    assert {r["file_path"] for r in found.collect()} == there and len(there) == 7
    assert any("a b" in f or "a%20b" in f for f in there)
    lengths = {r["file_path"]: r["size"] for r in found.collect()}
    assert all(size == len(open(f, "rb").read()) for f, size in lengths.items())
    assert found.agg(F.sum("rows")).first()[0] == 35
    uris = [r["uri"] for r in found.collect()]
    assert rows(landing.read_files(spark, uris), "offset") == sorted(((n,) for n in range(35)), key=lambda r: (False, str(r[0])))
    known = found.limit(3)
    assert lake.new_files(found, known).count() == 4
    assert lake.committed_files(spark, str(tmp_path / "none"), "x").isEmpty()
    assert lake.wrong_sizes(found, lake.file_lengths(spark, str(folder))).isEmpty()
    cut = lake.file_lengths(spark, str(folder)).withColumn("length", F.col("length") - 1)
    assert lake.wrong_sizes(found, cut).count() == 7


def test_a_topic_without_commits_is_refused(spark, small_lake, tmp_path):
    assert lake.inventory(spark, str(small_lake / "t"), "t").count() == 7
    (tmp_path / "day=1").mkdir()
    with pytest.raises(ValueError, match="no commit log in t"):
        lake.inventory(spark, str(tmp_path), "t")
    logs = tmp_path / lake.LOG_DIR
    logs.mkdir()
    (logs / "0").write_text("v1")
    with pytest.raises(ValueError, match="no committed files in t"):
        lake.inventory(spark, str(tmp_path), "t")


def test_ingestion_loads_once(spark, lake_dir, tmp_path):
    warehouse = str(tmp_path)
    assert landing.read_ledger(spark, warehouse).isEmpty()
    expected = {t: spark.read.parquet(f"{lake_dir}/{t}").count() for t in TOPICS}
    assert landing.run_ingestion(spark, lake_dir, warehouse, "listen_events") == {
        "listen_events": expected["listen_events"]
    }
    rest = landing.run_ingestion(spark, lake_dir, warehouse, max_files=7)
    assert rest == {t: n for t, n in expected.items() if t != "listen_events"}
    assert landing.run_ingestion(spark, lake_dir, warehouse) == {}
    for topic in TOPICS:
        table = landing.landing_table(spark, warehouse, topic)
        assert "hour" in table.columns and not {"year", "load_id"} & set(table.columns)
        stored = spark.read.parquet(f"{lake_dir}/{topic}").select(*table.columns)
        assert quality.reconcile_rows(stored, table).first()["passed"]
        files = lake.inventory(spark, f"{lake_dir}/{topic}", topic)
        ledger = landing.read_ledger(spark, warehouse).filter(F.col("topic") == topic)
        assert quality.reconcile_files(files, ledger).first()["passed"]
        fewer = ledger.filter(~F.col("file_path").endswith(
            files.agg(F.max("file_path")).first()[0].rsplit("/", 1)[1]))
        report = quality.reconcile_files(files, fewer).first()
        assert (report["files_missing_from_ledger"], report["passed"]) == (1, False)


def test_audit_of_a_live_topic(spark, tmp_path, monkeypatch):
    """Two committed files of five rows; one loaded, then both; then the lake moves."""
    lake_dir, warehouse, topic = tmp_path / "lake", str(tmp_path / "warehouse"), "auth_events"
    folder = lake_dir / topic / "year=2026"
    paths = []
    for n in range(2):
        part = spark.range(n * 5, n * 5 + 5).withColumn("hour", F.lit(8))
        part.coalesce(1).write.parquet(str(tmp_path / f"p{n}"))
        data = next((tmp_path / f"p{n}").glob("*.parquet")).read_bytes()
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"part-{n}.parquet").write_bytes(data)
        paths.append(str(folder / f"part-{n}.parquet"))
    logs = lake_dir / topic / "_spark_metadata"
    logs.mkdir()

    def commit(name, *files):
        entries = [
            {"path": f"file://{p}", "size": size, "isDir": False, "modificationTime": 0,
             "blockReplication": 1, "blockSize": 1, "action": "add"}
            for p, size in files
        ]
        (logs / name).write_text("\n".join(["v1", *map(json.dumps, entries)]))

    sizes = [len((folder / f"part-{n}.parquet").read_bytes()) for n in range(2)]
    commit("0", (paths[0], sizes[0]))
    assert landing.run_ingestion(spark, str(lake_dir), warehouse, topic) == {topic: 5}
    assert audit_topic(spark, str(lake_dir), warehouse, topic).first()["passed"]

    commit("1", (paths[1], sizes[1]))
    report = audit_topic(spark, str(lake_dir), warehouse, topic).first()
    assert (report["source_rows"], report["target_rows"], report["missing_rows"]) == (10, 5, 5)
    assert (report["files_missing_from_ledger"], report["passed"]) == (1, False)

    with monkeypatch.context() as patched:
        seen = iter([[("0", 1, 1)], [("0", 1, 1)], [("0", 1, 1), ("1", 1, 1)]])
        patched.setattr(lake, "commit_state", lambda *_: next(seen))
        with pytest.raises(ValueError, match="the lake changed"):
            audit_topic(spark, str(lake_dir), warehouse, topic)

    with monkeypatch.context() as patched:
        real = lake.file_lengths
        longer = F.col("length") + F.col("file_path").endswith("part-1.parquet").cast("int")
        patched.setattr(lake, "file_lengths", lambda *a: real(*a).withColumn("length", longer))
        with pytest.raises(ValueError, match="differs from its commit log: .*part-1.parquet"):
            audit_topic(spark, str(lake_dir), warehouse, topic)
    # A file that is no longer what was committed cannot be read as such.
    (folder / "part-1.parquet").write_bytes(b"PAR1")
    with pytest.raises(Exception, match="part-1.parquet|Parquet|length"):
        audit_topic(spark, str(lake_dir), warehouse, topic)


@pytest.mark.parametrize("step", ["write_ledger", "paths.put_new"])
def test_a_load_without_its_commit_is_invisible(spark, small_lake, tmp_path, monkeypatch, step):
    """Rows alone, or rows and ledger, but no commit: both are rolled back together."""
    warehouse = str(tmp_path)

    def fail(*_):
        raise OSError("the store is away")

    with monkeypatch.context() as patched:
        patched.setattr(f"cadenza.sources.landing.{step}", fail)
        with pytest.raises(OSError, match="the store is away"):
            landing.run_ingestion(spark, str(small_lake), warehouse, "t", max_files=3)
    assert landing.read_ledger(spark, warehouse).isEmpty()
    assert landing.stored_schema(spark, warehouse, "t") is None
    assert landing.run_ingestion(spark, str(small_lake), warehouse, ["t"]) == {"t": 35}
    assert landing.landing_table(spark, warehouse, "t").count() == 35
    assert landing.read_ledger(spark, warehouse).count() == 7


def test_two_runs_at_once_load_each_file_once(spark, small_lake, tmp_path):
    import threading

    warehouse, found = str(tmp_path), []

    def run():
        found.append(landing.run_ingestion(spark, str(small_lake), warehouse, "t", max_files=4))

    runs = [threading.Thread(target=run) for _ in range(3)]
    for r in runs:
        r.start()
    for r in runs:
        r.join()
    assert sum(f.get("t", 0) for f in found) == 35 and len(found) == 3
    table = landing.landing_table(spark, warehouse, "t")
    assert table.count() == table.select("offset").distinct().count() == 35
    ledger = landing.read_ledger(spark, warehouse)
    assert ledger.count() == ledger.select("file_path").distinct().count() == 7
    assert rows(ledger.groupBy("load_id").count(), "load_id") == [(1,), (2,)]
    # What the losers had read is gone.
    assert len(list((tmp_path / "landing" / "t").iterdir())) == 2


def test_later_files_are_matched_by_name(spark, tmp_path):
    def write(name, df):
        df.coalesce(1).write.parquet(str(tmp_path / name))
        path = next((tmp_path / name).glob("*.parquet"))
        return [{"file_path": str(path), "uri": str(path), "batch_id": 0}]

    warehouse = str(tmp_path / "warehouse")
    base = spark.createDataFrame([(1, "a")], "id int, name string")
    assert landing.load_files(spark, warehouse, "t", write("one", base)) == 1
    swapped = spark.createDataFrame([("b", 2)], "name string, id int")
    landing.load_files(spark, warehouse, "t", write("two", swapped))
    landing.load_files(spark, warehouse, "t", write("three", base.select(F.lit(3).alias("id"))))
    assert rows(landing.landing_table(spark, warehouse, "t")) == [(1, "a"), (2, "b"), (3, None)]
    with pytest.raises(ValueError, match="columns not in the landing table: more"):
        landing.load_files(spark, warehouse, "t", write("four", base.withColumn("more", F.lit(1))))
    assert landing.landing_table(spark, warehouse, "t").count() == 3


def test_ledger_counts_successes_only(spark):
    ledger = spark.createDataFrame([("/ok", "SUCCESS"), ("/bad", "FAILED")],
                                   "file_path string, status string")
    assert rows(landing.loaded_paths(ledger)) == [("/ok",)]


def test_keyed_messages(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(
        '{"userId": 79, "city": "Đà Nẵng"}\n\n  \n{"city": "x"}\n{"broken": \n'
    )
    (tmp_path / "b.jsonl").write_text('{"userId":81}')
    (tmp_path / "c.txt").write_text('{"userId":99}')
    found = messages.keyed_messages(messages.read_lines(spark, str(tmp_path)))
    assert rows(found) == [("", '{"city": "x"}'), ("79", '{"userId": 79, "city": "Đà Nẵng"}'),
                           ("81", '{"userId":81}')]


def test_cycle_twice(spark, lake_dir, tmp_path, capsys):
    warehouse = str(tmp_path)
    with pytest.raises(quality.CheckFailed) as failed:
        run_cycle(spark, lake_dir, str(tmp_path / "strict"), "2026-11-01 00:00:00")
    # The streams hold what real feeds do, and the checks of the intermediate layer name it.
    planted = [f.rsplit(": ", 1)[0] for f in str(failed.value).split("; ")]
    assert "int_dim_song.song_name not_null" in planted
    assert "int_dim_location.location_state not_null" in planted
    loaded, first = run_cycle(spark, lake_dir, warehouse, "2026-11-01 00:00:00", planted)
    assert set(loaded) == set(TOPICS)
    fact = rows(first["fact_song_play"])
    plays = rows(first["song_plays"])
    assert len(fact) == len(plays) == first["int_fact_song_play"].count() > 500

    again, second = run_cycle(spark, lake_dir, warehouse, "2026-11-02 00:00:00", planted)
    assert again == {}
    assert rows(second["fact_song_play"]) == fact and rows(second["song_plays"]) == plays
    times = Counter(str(r[0]) for r in rows(second["dim_user"], "inserted_time"))
    assert set(times) == {"2026-11-02 00:00:00"}
    assert read_table(spark, warehouse, "dashboard", "filter_options").count() > 0

    stored, _ = stored_dashboard(spark, warehouse)
    main(["report", "--warehouse", warehouse, "--start", "2024-01-05", "--end", "2024-01-06"])
    shown = capsys.readouterr().out
    checks = read_table(spark, warehouse, "intermediate", "checks")
    assert {r["name"] for r in checks.filter("violations > 0").collect()} == set(planted)
    assert read_table(spark, warehouse, "intermediate", "missing_dimensions").first()[0] == len(fact)
    bundle = reports.load_report(stored, date(2024, 1, 5), date(2024, 1, 6))
    assert all(name in shown for name in bundle)
    assert len(bundle["daily"].collect()) == 2
    with pytest.raises(ValueError, match="dashboard tables are missing"):
        stored_dashboard(spark, str(tmp_path / "nowhere"))


def test_an_empty_topic_has_no_rows(spark, tmp_path):
    empty = landing.landing_table(spark, str(tmp_path), "auth_events")
    assert empty.isEmpty() and {"offset", "raw_json", "userId", "hour"} <= set(empty.columns)


def test_a_commit_out_of_reach_is_no_empty_ledger(spark, small_lake, tmp_path):
    landing.run_ingestion(spark, str(small_lake), str(tmp_path), "t")
    broken = tmp_path / "landing" / "commits" / "t" / "0000000001.json"
    broken.write_text("{broken")
    with pytest.raises(Exception, match="(?i)malformed|json"):
        landing.loaded_paths(landing.read_ledger(spark, str(tmp_path))).collect()
    assert landing.read_ledger(spark, str(tmp_path / "nowhere")).isEmpty()
