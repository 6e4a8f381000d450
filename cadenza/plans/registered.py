"""The registered queries: every operator over whole tables derived from the given data."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from cadenza.functions.clock import day_part, seconds_between
from cadenza.functions.keys import exact, from_epoch_ms, surrogate_key
from cadenza.operators import (
    dashboard, declared, dimensions, fact, history, marts, quality, reports, staging,
)
from cadenza.operators.ordered import Chunks, chunk_seconds_for, chunks_for
from cadenza.plans.audit import audit_topic
from cadenza.schemas import EVENT_SCHEMAS, TOPICS
from cadenza.session import shared_dir, prepare
from cadenza.sources import events, increments, lake, landing, messages
from cadenza.sources.paths import exists, make_dir
from cadenza.sources.tables import read_table, store_fact
from cadenza.streaming.decode import decode
from cadenza.streaming.sink import finish, settle, start_topics

RUN_TS = "2024-02-01 06:00:00"
NEXT_RUN_TS = "2024-02-02 06:00:00"
CUTOFF = "2024-01-20 12:00:00"
START, END = date(2024, 1, 5), date(2024, 1, 25)
STATES = ["NATION_1", "NATION_2", "NATION_3", "NATION_4", "Unknown"]
GENDERS = ["F", "Unknown"]

Query = Callable[[SparkSession, str], DataFrame]

_stored: dict[tuple, tuple[str, object]] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], object]):
    """Work shared by queries of one session, kept in the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    path, value = _stored.get(key, (None, None))
    if path is None or not exists(spark, path):
        path = f"{shared_dir(spark)}/cadenza-{uuid.uuid4().hex}/{name}"
        value = build(path)
        _stored[key] = (path, value)
    return value


class Source:
    """The layers over one data folder, each a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = prepare(spark), sf_dir

    def table(self, name: str) -> DataFrame:
        return events.table(self.spark, self.sf_dir, name)

    def described(self) -> DataFrame:
        return events.read_described(self.spark, self.sf_dir)

    def landing(self, topic: str) -> DataFrame:
        return events.landing_rows(self.described(), topic)

    # Tables that later layers read, written once per session as the warehouse cycle does.

    def written(self, name: str, plan: Callable[[], DataFrame]) -> DataFrame:
        def build(path: str) -> DataFrame:
            df = plan()
            df.write.parquet(path)
            return self.spark.read.schema(df.schema).parquet(path)

        return _once(self.spark, self.sf_dir, name, build)

    def landed(self, topic: str) -> DataFrame:
        return self.written(f"land_{topic}", lambda: self.landing(topic))

    def stg(self, topic: str) -> DataFrame:
        return self.written(f"stg_{topic}", lambda: staging.stage(self.landing(topic), topic))

    @property
    def listen(self) -> DataFrame:
        return self.stg("listen_events")

    @property
    def page_view(self) -> DataFrame:
        return self.stg("page_view_events")

    def chunks(self) -> Chunks:
        """The chunks that the cycle would take for this data."""
        def build(path: str) -> Chunks:
            def keep(cuts: DataFrame) -> DataFrame:
                cuts.write.parquet(path)
                return self.spark.read.schema(cuts.schema).parquet(path)

            events = _union(self.stg(t).select("userId", "ts") for t in TOPICS)
            chunks = chunks_for(events, "userId", "ts", chunk_seconds_for(self.page_view), keep)
            make_dir(self.spark, path)
            return chunks

        return _once(self.spark, self.sf_dir, "hot-chunks", build)

    def observations(self) -> DataFrame:
        return history.user_observations(*(self.stg(t) for t in TOPICS))

    def users(self) -> DataFrame:
        return history.int_dim_user(
            self.stg("auth_events"), self.listen, self.page_view, self.stg("status_change_events"),
            self.chunks(),
        )

    def int_dim(self, name: str) -> DataFrame:
        plans = {
            "dim_date": lambda: dimensions.int_dim_date(self.listen),
            "dim_time": lambda: dimensions.int_dim_time(self.listen),
            "dim_user": self.users,
            "dim_song": lambda: dimensions.int_dim_song(self.listen),
            "dim_location": lambda: dimensions.int_dim_location(self.page_view),
            "dim_session": lambda: dimensions.int_dim_session(self.page_view),
        }
        return self.written(f"int_{name}", plans[name])

    def int_fact_plan(self) -> DataFrame:
        return fact.int_fact_song_play(
            self.listen,
            self.page_view,
            dates=self.int_dim("dim_date"),
            times=self.int_dim("dim_time"),
            users=self.int_dim("dim_user"),
            songs=self.int_dim("dim_song"),
            locations=self.int_dim("dim_location"),
            sessions=self.int_dim("dim_session"),
            disjoint=True,  # periods end where the next one starts
            seconds=self.chunks(),
        )

    def int_fact(self) -> DataFrame:
        return self.written("int_fact_song_play", self.int_fact_plan)

    def mart_dim(self, dim: marts.Dimension) -> DataFrame:
        return marts.build_dimension(self.int_dim(dim.name), dim, RUN_TS)

    def mart_fact(self) -> DataFrame:
        return marts.fact_rows(self.int_fact(), RUN_TS)

    def earlier_fact(self) -> DataFrame:
        """The intermediate fact as it was when the last event seen was at the cut-off: no later
        plays, and plays not yet followed by an event have no end."""
        cut = F.lit(CUTOFF).cast("timestamp")
        ended = F.col("play_ended_at") < cut
        return self.int_fact().filter(F.col("play_started_at") < cut).withColumns(
            {c: F.when(ended, F.col(c)) for c in ("play_ended_at", "listened_seconds")}
        )

    def song_plays_plan(self) -> DataFrame:
        return dashboard.song_plays(
            self.mart_fact(),
            self.mart_dim(marts.DIM_LOCATION),
            self.mart_dim(marts.DIM_USER),
            self.mart_dim(marts.DIM_SONG),
        )

    def song_plays(self) -> DataFrame:
        return self.written("song_plays", self.song_plays_plan)

    def filter_options(self) -> DataFrame:
        return dashboard.filter_options(
            self.mart_dim(marts.DIM_LOCATION), self.mart_dim(marts.DIM_USER)
        )

    def selected(self) -> DataFrame:
        return reports.select_plays(self.song_plays(), START, END)

    def lake(self) -> str:
        """The events streamed through the decoder into a lake, all topics, once per session."""

        def build(path: str) -> str:
            stream = events.described_stream(self.spark, self.sf_dir)
            finish(
                start_topics(
                    self.spark,
                    lambda topic: events.broker_rows(stream, topic),
                    f"{path}/events",
                    f"{path}/checkpoint",
                    trigger=None,
                )
            )
            return f"{path}/events"

        return _once(self.spark, self.sf_dir, "lake", build)

    def warehouse(self) -> tuple[str, dict[str, int], dict[str, int]]:
        """The lake ingested twice: folder, rows of the first run, rows of the second."""

        def build(path: str):
            first = landing.run_ingestion(self.spark, self.lake(), path)
            return path, first, landing.run_ingestion(self.spark, self.lake(), path)

        return _once(self.spark, self.sf_dir, "warehouse", build)

    def half_warehouse(self) -> str:
        """The lake ingested in part: two topics of four."""

        def build(path: str) -> str:
            landing.run_ingestion(self.spark, self.lake(), path, TOPICS[:2])
            return path

        return _once(self.spark, self.sf_dir, "half-warehouse", build)

    def files(self, topic: str) -> DataFrame:
        return lake.inventory(self.spark, f"{self.lake()}/{topic}", topic)

    def layer(self, layer: str) -> dict[str, DataFrame]:
        """The tables of a layer by name."""
        if layer == "intermediate":
            names = [d.name for d in marts.DIMENSIONS]
            return {f"int_{n}": self.int_dim(n) for n in names} | {
                "int_fact_song_play": self.int_fact()
            }
        if layer == "marts":
            return {d.name: self.mart_dim(d) for d in marts.DIMENSIONS} | {
                "fact_song_play": self.mart_fact()
            }
        return {"song_plays": self.song_plays(), "filter_options": self.filter_options()}


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def naive_times(df: DataFrame) -> DataFrame:
    """Timestamps leave as UTC wall-clock times."""
    zoned = {f.name for f in df.schema if f.dataType.typeName() == "timestamp"}
    return df.select(
        *[F.col(c).cast("timestamp_ntz").alias(c) if c in zoned else F.col(c) for c in df.columns]
    )


_PLAY = ["userId", "sessionId", "itemInSession", "ts"]

_QUERIES: dict[str, Callable[[Source], DataFrame]] = {}


def _query(name: str):
    def add(build: Callable[[Source], DataFrame]):
        _QUERIES[name] = build
        return build

    return add


# --- sources -------------------------------------------------------------------------------------


@_query("s2_decode")
def _(s: Source) -> DataFrame:
    """All topics; columns that a topic does not have are NULL."""

    def decoded(topic: str) -> DataFrame:
        rows = decode(events.broker_rows(s.described(), topic), EVENT_SCHEMAS[topic])
        # The raw text stays as it came: asked for two of its fields.
        return rows.select(
            *[F.col(c).cast("bigint") if c == "sessionId" else c for c in rows.columns
              if c != "raw_json"],
            F.get_json_object("raw_json", "$.ts").cast("bigint").alias("raw_ts"),
            F.get_json_object("raw_json", "$.city").alias("raw_city"),
        )

    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [decoded(t) for t in TOPICS]
    )


@_query("s4_stream_sink")
def _(s: Source) -> DataFrame:
    def day(topic: str) -> DataFrame:
        rows = s.spark.read.parquet(f"{s.lake()}/{topic}")
        return rows.groupBy("topic", "year", "month", "day").agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("userId").alias("users")
        )

    return _union(day(t) for t in TOPICS)


@_query("s5_topic_states")
def _(s: Source) -> DataFrame:
    # Four queries at once; one meets a record that stops it and leaves the others alone.
    def build(path: str) -> DataFrame:
        stream = events.described_stream(s.spark, s.sf_dir)

        def read(topic: str) -> DataFrame:
            rows = events.broker_rows(stream, topic)
            if topic != TOPICS[-1]:
                return rows
            broken = F.when(F.col("offset") >= 0, F.raise_error(F.lit("record cannot be read")))
            return rows.withColumn("value", F.coalesce(broken.cast("binary"), "value"))

        started = start_topics(s.spark, read, f"{path}/lake", f"{path}/check", trigger=None)
        states = settle(started).drop("batches", "error")
        files = _union(lake.committed_files(s.spark, f"{path}/lake/{t}", t) for t in TOPICS[:-1])
        rows = files.groupBy("topic").agg(F.sum("rows").alias("n"))
        found = states.join(rows, "topic", "left")
        found.write.parquet(f"{path}/states")
        return s.spark.read.schema(found.schema).parquet(f"{path}/states")

    return _once(s.spark, s.sf_dir, "topic-states", build)


@_query("s6_committed_files")
def _(s: Source) -> DataFrame:
    # The committed files hold the rows sent, no more and no fewer.
    files = _union(
        lake.committed_files(s.spark, f"{s.lake()}/{topic}", topic) for topic in TOPICS
    )
    return files.groupBy("topic").agg(F.sum("rows").alias("n"))


@_query("s7_ledger_new_files")
def _(s: Source) -> DataFrame:
    # Two topics of four are loaded: rows in the files the ledger names, and in those still new.
    path = s.half_warehouse()
    pending = landing.pending_files(s.spark, s.lake(), path, TOPICS)
    known = landing.loaded_paths(landing.read_ledger(s.spark, path))
    loaded = _union(s.files(t) for t in TOPICS).join(known, "file_path", "left_semi")
    states = [
        files.groupBy("topic").agg(F.sum("rows").alias("n")).withColumn("state", F.lit(state))
        for state, files in (("pending", pending), ("loaded", loaded))
    ]
    return _union(states)


@_query("s8_landing_rows")
def _(s: Source) -> DataFrame:
    path, _first, _second = s.warehouse()
    tables = (landing.landing_table(s.spark, path, t) for t in TOPICS)
    return _union(
        df.groupBy("topic").agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("offset").alias("offsets")
        )
        for df in tables
    )


@_query("s9_ingestion")
def _(s: Source) -> DataFrame:
    path, first, second = s.warehouse()
    loads = landing.read_ledger(s.spark, path).groupBy("topic").agg(
        F.count_distinct("load_id").alias("loads")
    )
    rows = [(t, first.get(t, 0), second.get(t, 0)) for t in TOPICS]
    counted = s.spark.createDataFrame(rows, "topic string, first_run bigint, second_run bigint")
    return counted.join(loads, "topic")


@_query("s10_inventory")
def _(s: Source) -> DataFrame:
    # Files of the inventory by day, but for those cut short on disk: here, a topic's first three.
    def held(topic: str) -> DataFrame:
        files, folder = s.files(topic), f"{s.lake()}/{topic}"
        lengths = lake.file_lengths(s.spark, folder)
        short = F.col("file_path").rlike("/month=1/day=[123]/")
        cut = lengths.withColumn("length", F.col("length") - short.cast("int"))
        wrong = lake.wrong_sizes(files, cut).select("file_path", F.lit(True).alias("wrong"))
        day = F.regexp_extract("file_path", "/day=([0-9]+)/", 1).cast("int")
        return files.join(wrong, "file_path", "left").groupBy("topic", day.alias("day")).agg(
            F.sum("rows").alias("n"), F.bool_or(F.coalesce("wrong", F.lit(False))).alias("wrong")
        )

    return _union(held(t) for t in TOPICS)


@_query("s11_keyed_messages")
def _(s: Source) -> DataFrame:
    # Lines as a feed delivers them: some blank, some cut off in the middle.
    fields = EVENT_SCHEMAS["auth_events"].fieldNames()
    rows = s.described().filter(F.col("event_type") == "signup")
    record = F.to_json(F.struct(*fields))
    line = (
        F.when(F.col("k") == 3, "  ")
        .when(F.col("k") == 4, F.concat(F.lit('{"ts": '), F.col("ts").cast("string")))
        .otherwise(record)
    )
    sent = messages.keyed_messages(rows.select(line.alias("value")))
    return sent.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.get_json_object("value", "$.ts").cast("bigint")).alias("ts_sum"),
    )


# --- staging -------------------------------------------------------------------------------------


@_query("t1_stg_auth_events")
def _(s: Source) -> DataFrame:
    return staging.stg_auth_events(s.landing("auth_events"))


@_query("t2_stg_listen_events")
def _(s: Source) -> DataFrame:
    return staging.stg_listen_events(s.landing("listen_events"))


@_query("t3_stg_page_view_events")
def _(s: Source) -> DataFrame:
    return staging.stg_page_view_events(s.landing("page_view_events"))


@_query("t4_stg_status_change_events")
def _(s: Source) -> DataFrame:
    return staging.stg_status_change_events(s.landing("status_change_events"))


@_query("t5_epoch_ms")
def _(s: Source) -> DataFrame:
    return s.described().select("event_id", "ts", from_epoch_ms(F.col("ts")).alias("happened_at"))


@_query("t6_exact_dedupe")
def _(s: Source) -> DataFrame:
    rows = s.landed("page_view_events")
    kept = staging.exact_rows(rows, EVENT_SCHEMAS["page_view_events"].fieldNames())
    counts = rows.groupBy("page").agg(F.count(F.lit(1)).alias("delivered"))
    return counts.join(kept.groupBy("page").agg(F.count(F.lit(1)).alias("kept")), "page")


@_query("t7_exact_decimal")
def _(s: Source) -> DataFrame:
    # As doubles and as floats: both round half up to three places.
    value = s.table("events").select("event_id", "value")
    return value.select(
        "event_id", exact((F.col("value") / 7).cast("float")).alias("from_float")
    )


@_query("t8_surrogate_key")
def _(s: Source) -> DataFrame:
    rows = s.listen
    return rows.select(
        "userId", "sessionId", "ts", "song", "duration", "state",
        surrogate_key("userId", "sessionId", "ts", "song", "duration", "state").alias("hash_key"),
    )


# --- dimensions ----------------------------------------------------------------------------------


@_query("d1_int_dim_date")
def _(s: Source) -> DataFrame:
    return dimensions.int_dim_date(s.listen)


@_query("d2_int_dim_time")
def _(s: Source) -> DataFrame:
    return dimensions.int_dim_time(s.listen)


@_query("d3_day_part")
def _(s: Source) -> DataFrame:
    hour = F.hour("ts")
    return s.table("events").select(hour.alias("hour"), day_part(hour).alias("part")).groupBy(
        "hour", "part"
    ).agg(F.count(F.lit(1)).alias("n"))


@_query("d4_int_dim_location")
def _(s: Source) -> DataFrame:
    return dimensions.int_dim_location(s.page_view)


@_query("d5_int_dim_session")
def _(s: Source) -> DataFrame:
    return dimensions.int_dim_session(s.page_view)


@_query("d6_int_dim_song")
def _(s: Source) -> DataFrame:
    return dimensions.int_dim_song(s.listen)


@_query("d7_user_observations")
def _(s: Source) -> DataFrame:
    return s.observations()


@_query("d8_change_flags")
def _(s: Source) -> DataFrame:
    return history.change_flags(s.observations(), seconds=s.chunks())


@_query("d9_version_numbers")
def _(s: Source) -> DataFrame:
    return history.version_numbers(s.observations(), seconds=s.chunks())


@_query("d10_version_starts")
def _(s: Source) -> DataFrame:
    return history.version_starts(s.observations(), seconds=s.chunks())


@_query("d11_int_dim_user")
def _(s: Source) -> DataFrame:
    return s.users()


# --- fact ----------------------------------------------------------------------------------------


@_query("f1_timeline")
def _(s: Source) -> DataFrame:
    return fact.timeline(s.listen, s.page_view)


@_query("f2_next_event")
def _(s: Source) -> DataFrame:
    return fact.next_event(fact.timeline(s.listen, s.page_view), s.chunks())


@_query("f3_end_time")
def _(s: Source) -> DataFrame:
    events_ = fact.event_ids(s.listen, s.page_view)
    instants = fact.session_instants(events_, s.chunks(), known_only=True)
    return fact.attach_end_time(s.listen.select(*_PLAY), instants, s.chunks())


@_query("f4_date_lookup")
def _(s: Source) -> DataFrame:
    return fact.attach_date(s.listen.select(*_PLAY), s.int_dim("dim_date"))


@_query("f5_time_lookup")
def _(s: Source) -> DataFrame:
    return fact.attach_time(s.listen.select(*_PLAY), s.int_dim("dim_time"))


@_query("f6_scd2_lookup")
def _(s: Source) -> DataFrame:
    return fact.attach_user(s.listen.select(*_PLAY), s.int_dim("dim_user"), seconds=s.chunks())


@_query("f7_song_lookup")
def _(s: Source) -> DataFrame:
    plays = s.listen.select(*_PLAY, "artist", "song", "duration")
    return fact.attach_song(plays, s.int_dim("dim_song"))


@_query("f8_location_lookup")
def _(s: Source) -> DataFrame:
    plays = s.listen.select(*_PLAY, "city", "zip", "state", "lon", "lat")
    return fact.attach_location(plays, s.int_dim("dim_location"))


@_query("f9_session_lookup")
def _(s: Source) -> DataFrame:
    return fact.attach_session(s.listen.select(*_PLAY), s.int_dim("dim_session"))


@_query("f10_pruned_lookup")
def _(s: Source) -> DataFrame:
    return fact.lookup(s.int_dim("dim_session"), "user_id", "session_id")


@_query("f11_listened_seconds")
def _(s: Source) -> DataFrame:
    instants = fact.session_instants(fact.event_ids(s.listen, s.page_view), s.chunks())
    plays = fact.attach_end_time(s.listen.select(*_PLAY), instants, s.chunks())
    return plays.select(
        *_PLAY, seconds_between(F.col("ts"), F.col("play_ended_at")).alias("listened_seconds")
    )


@_query("f12_int_fact_song_play")
def _(s: Source) -> DataFrame:
    return s.int_fact_plan()


@_query("f13_timeline_conflicts")
def _(s: Source) -> DataFrame:
    # Page views of one state report a second late.
    late = F.when(
        F.col("state") == "NATION_3", F.col("ts") + F.expr("interval 1 second")
    ).otherwise(F.col("ts"))
    return fact.timeline_conflicts(fact.event_ids(s.listen, s.page_view.withColumn("ts", late)))


# --- marts ---------------------------------------------------------------------------------------

for _number, _dim in enumerate(
    [marts.DIM_USER, marts.DIM_SONG, marts.DIM_SESSION, marts.DIM_LOCATION, marts.DIM_DATE,
     marts.DIM_TIME], start=1,
):
    _QUERIES[f"m{_number}_{_dim.name}"] = lambda s, dim=_dim: s.mart_dim(dim)


@_query("m7_distinct_before_defaults")
def _(s: Source) -> DataFrame:
    songs = s.int_dim("dim_song")
    named = songs.withColumn("song_name", F.coalesce("song_name", F.lit("Unknown")))
    return marts.distinct_source(songs.unionByName(named))


@_query("m8_bad_keys")
def _(s: Source) -> DataFrame:
    key = F.when(F.col("location_state").isNull(), "-1").when(
        F.col("location_city") != "ASIA", F.col("location_key")
    )
    return marts.bad_keys(s.int_dim("dim_location").withColumn("location_key", key),
                          marts.DIM_LOCATION)


@_query("m9_with_unknown")
def _(s: Source) -> DataFrame:
    return marts.with_unknown(s.int_dim("dim_location"), marts.DIM_LOCATION)


@_query("m10_audit")
def _(s: Source) -> DataFrame:
    return marts.with_audit(s.int_dim("dim_date").select("date_key"), RUN_TS)


@_query("m11_source_identity")
def _(s: Source) -> DataFrame:
    return marts.source_identity(s.int_fact())


@_query("m12_default_foreign_keys")
def _(s: Source) -> DataFrame:
    return marts.default_foreign_keys(s.int_fact())


@_query("m13_changed_rows")
def _(s: Source) -> DataFrame:
    stored = marts.fact_rows(s.earlier_fact(), RUN_TS)
    return marts.changed_rows(marts.default_foreign_keys(s.int_fact()), stored)


@_query("m14_upsert")
def _(s: Source) -> DataFrame:
    stored = marts.fact_rows(s.earlier_fact(), RUN_TS)
    return marts.fact_song_play(s.int_fact(), stored, NEXT_RUN_TS)


@_query("s14_stored_fact")
def _(s: Source) -> DataFrame:
    # Two runs on a stored fact, read back: the plays known at the cut-off, then all of them.
    def build(path: str) -> str:
        store_fact(s.earlier_fact(), path, RUN_TS)
        store_fact(s.int_fact(), path, NEXT_RUN_TS)
        return path

    path = _once(s.spark, s.sf_dir, "stored-fact", build)
    return read_table(s.spark, path, "marts", "fact_song_play")


@_query("t6_two_loads")
def _(s: Source) -> DataFrame:
    # Staging extended load by load, the second holding some rows of the first again, against the
    # copies delivered: rows by day.
    def build(path: str) -> str:
        rows, topic = s.landed("page_view_events"), "page_view_events"
        later = F.col("ts") >= F.lit(CUTOFF).cast("timestamp")
        for load in (rows.filter(~later), rows.filter(later | (F.col("offset") % 7 == 0))):
            aside = f"{path}/in/{uuid.uuid4().hex}"
            load.write.parquet(aside)
            files = s.spark.read.parquet(aside).select(
                F.col("_metadata.file_path").alias("uri")).distinct().collect()
            landing.load_files(
                s.spark, path, topic, [{"uri": f["uri"], "file_path": f["uri"]} for f in files]
            )
            increments.extend_staging(s.spark, path, topic)
        return path

    path = _once(s.spark, s.sf_dir, "two-loads", build)
    return increments.staged(s.spark, path, "page_view_events")


@_query("d11_extended_history")
def _(s: Source) -> DataFrame:
    # The user dimension extended from two states of the landing tables: some users are seen late.
    def build(path: str) -> str:
        late = F.col("userId") % 5 == 0
        early = F.col("ts") < F.lit(CUTOFF).cast("timestamp")
        for number in (1, 2):
            for topic in TOPICS:
                rows = s.landed(topic)
                first = F.coalesce(early & ~late, F.lit(True)) | (F.col("offset") % 3 == 0)
                aside = f"{path}/in/{topic}-{number}"
                rows.filter(first if number == 1 else ~first).write.parquet(aside)
                files = s.spark.read.parquet(aside).select(
                    F.col("_metadata.file_path").alias("uri")).distinct().collect()
                landing.load_files(
                    s.spark, path, topic, [{"uri": f["uri"], "file_path": f["uri"]} for f in files]
                )
                increments.extend_staging(s.spark, path, topic)
            increments.extend_history(s.spark, path)
        return path

    path = _once(s.spark, s.sf_dir, "extended-history", build)
    return increments.extend_history(s.spark, path)


@_query("m15_schema_guard")
def _(s: Source) -> DataFrame:
    # What the guard says to a fact with other columns, over the plays each of them concerns.
    fact_rows = s.mart_fact()
    others = {
        "as stored": fact_rows,
        "without a column": fact_rows.drop("song_key"),
        "of another type": fact_rows.withColumn("user_id", F.col("user_id").cast("bigint")),
    }

    def verdict(rows: DataFrame) -> str:
        try:
            marts.reject_schema_change(fact_rows.schema, rows.schema)
        except ValueError as refused:
            return str(refused)
        return "accepted"

    return _union(
        rows.agg(F.count(F.lit(1)).alias("plays")).select(
            F.lit(name).alias("incoming"), F.lit(verdict(rows)).alias("verdict"), "plays"
        )
        for name, rows in others.items()
    )


# --- dashboard and reports -----------------------------------------------------------------------


@_query("p1_song_plays")
def _(s: Source) -> DataFrame:
    return s.song_plays_plan()


@_query("p2_filter_options")
def _(s: Source) -> DataFrame:
    return s.filter_options()


@_query("r0_reader_guard")
def _(s: Source) -> DataFrame:
    reports.reject_bad_tables(s.song_plays(), s.filter_options())
    return marts.source_identity(s.song_plays())


@_query("r1_metadata")
def _(s: Source) -> DataFrame:
    return reports.metadata(s.song_plays())


@_query("r1_filter_values")
def _(s: Source) -> DataFrame:
    return reports.filter_values(s.filter_options(), "states")


@_query("r2_select_plays")
def _(s: Source) -> DataFrame:
    return reports.select_plays(s.song_plays(), START, END, STATES, GENDERS)


@_query("r3_summary")
def _(s: Source) -> DataFrame:
    return reports.summary(s.selected())


@_query("r4_top_states")
def _(s: Source) -> DataFrame:
    return reports.top_states(s.selected())


@_query("r5_top_songs")
def _(s: Source) -> DataFrame:
    return reports.top_songs(s.selected())


@_query("r6_top_song_per_gender")
def _(s: Source) -> DataFrame:
    return reports.top_song_per_gender(s.selected())


@_query("r7_heatmap")
def _(s: Source) -> DataFrame:
    return reports.hourly_heatmap(s.selected())


@_query("r8_daily_trend")
def _(s: Source) -> DataFrame:
    return reports.daily_trend(s.selected(), START, END)


@_query("r9_top_artists")
def _(s: Source) -> DataFrame:
    return reports.top_artists(s.selected())


@_query("r10_derived_figures")
def _(s: Source) -> DataFrame:
    return reports.derived_figures(reports.summary(s.selected()))


@_query("r11_peak_hour")
def _(s: Source) -> DataFrame:
    plays = s.selected()
    return reports.peak_hour(reports.hourly_heatmap(plays), reports.summary(plays))


@_query("r12_leading_songs")
def _(s: Source) -> DataFrame:
    plays = s.selected()
    return reports.leading_songs(reports.top_songs(plays), reports.summary(plays))


@_query("r13_report_bundle")
def _(s: Source) -> DataFrame:
    # Seven reports from one scan of the selection: its groups are written and read by all.
    bundle = reports.load_report(
        s.song_plays(), START, END, STATES, GENDERS,
        keep=lambda groups: s.written("report_groups", lambda: groups),
    )
    return reports.report_rows(bundle)


# --- quality -------------------------------------------------------------------------------------


@_query("q1_not_null")
def _(s: Source) -> DataFrame:
    return quality.not_null(s.int_fact(), "session_key").select("play_key", "session_key")


@_query("q2_unique")
def _(s: Source) -> DataFrame:
    return quality.unique(s.int_fact(), "song_key")


@_query("q3_accepted_values")
def _(s: Source) -> DataFrame:
    return quality.accepted_values(s.page_view, "page", ["NextSong", "Home"])


@_query("q4_relationships")
def _(s: Source) -> DataFrame:
    # Against the users known at the cut-off.
    known = s.int_dim("dim_user").filter(F.col("start_time") < F.lit(CUTOFF).cast("timestamp"))
    return quality.relationships(s.mart_fact(), "user_key", known, "user_key")


@_query("q5_unique_together")
def _(s: Source) -> DataFrame:
    return quality.unique_together(s.int_dim("dim_session"), ["user_id", "session_id"])


@_query("q6_expression_is_true")
def _(s: Source) -> DataFrame:
    # The valid time key holds everywhere; shifted by six hours it does not.
    shifted = s.mart_fact().withColumn("shifted", F.col("play_time_key") + 21600)
    return quality.expression_is_true(shifted, quality.valid_time_key("shifted")).select(
        "play_key", "play_time_key"
    )


@_query("q7_bad_durations")
def _(s: Source) -> DataFrame:
    # Plays without a location lose their duration; plays without a session get whole seconds.
    seconds = F.col("listened_seconds")
    broken = F.when(F.col("session_key").isNull(), F.floor(seconds).cast("double")).when(
        F.col("location_key").isNotNull(), seconds
    )
    return quality.bad_durations(s.int_fact().withColumn("listened_seconds", broken))


@_query("q8_bad_audit")
def _(s: Source) -> DataFrame:
    tables = {d.name: s.mart_dim(d) for d in marts.DIMENSIONS}
    stored = marts.fact_rows(s.earlier_fact(), RUN_TS)
    tables["fact_song_play"] = marts.fact_song_play(s.int_fact(), stored, NEXT_RUN_TS)
    # A copy of the fact whose late plays were touched by hand.
    hand = F.when(F.col("play_started_at") < F.lit(CUTOFF).cast("timestamp"), marts.LOADER)
    tables["fact_by_hand"] = tables["fact_song_play"].withColumn("updated_by", hand)
    return quality.bad_audit(tables)


@_query("q9_fact_not_preserved")
def _(s: Source) -> DataFrame:
    return quality.fact_not_preserved(s.int_fact(), marts.fact_rows(s.earlier_fact(), RUN_TS))


@_query("q10_bad_unknown_member")
def _(s: Source) -> DataFrame:
    # Sound for songs. Locations as they come have no Unknown row, sessions have one with another
    # default, and some users carry the reserved key.
    user, session = marts.DIM_USER, marts.DIM_SESSION
    sessions = s.mart_dim(session).withColumn(
        "session_number",
        F.when(F.col("session_key") != "-1", F.col("session_number")).otherwise(F.lit(0)),
    )
    users = s.int_dim("dim_user").withColumn(
        "user_key", F.when(F.col("user_id") % 10 == 3, "-1").otherwise(F.col("user_key"))
    )
    checked = [
        (s.int_dim("dim_song"), s.mart_dim(marts.DIM_SONG), marts.DIM_SONG),
        (s.int_dim("dim_location"), s.int_dim("dim_location"), marts.DIM_LOCATION),
        (s.int_dim("dim_session"), sessions, session),
        (users, s.mart_dim(user), user),
    ]
    return _union(quality.bad_unknown_member(*c) for c in checked).groupBy("problem").agg(
        F.count(F.lit(1)).alias("n")
    )


@_query("q11_dashboard_not_preserved")
def _(s: Source) -> DataFrame:
    return quality.dashboard_not_preserved(
        marts.fact_rows(s.earlier_fact(), RUN_TS), s.song_plays()
    )


@_query("q12_reconcile_rows")
def _(s: Source) -> DataFrame:
    # What went through stream, lake and ingestion against the rows sent, and against staging, which
    # lost the copies.
    topic = "page_view_events"
    path, _first, _second = s.warehouse()
    sent = s.landed(topic)
    landed = landing.landing_table(s.spark, path, topic).select(*sent.columns)
    same = quality.reconcile_rows(sent, landed).withColumn("pair", F.lit("landing"))
    raw = sent.select(*EVENT_SCHEMAS[topic].fieldNames())
    deduped = quality.reconcile_rows(raw, raw.distinct()).withColumn("pair", F.lit("deduped"))
    return same.unionByName(deduped)


@_query("q12_reconcile_lineitem")
def _(s: Source) -> DataFrame:
    items = s.table("lineitem")
    shipped = items.withColumn(
        "l_linestatus", F.when(F.col("l_returnflag") == "R", "X").otherwise(F.col("l_linestatus"))
    )
    return quality.reconcile_rows(items, shipped)


@_query("q13_reconcile_files")
def _(s: Source) -> DataFrame:
    # Rows in files that one side lacks: none as loaded; then the ledger, and then the lake, without
    # the files of the month's first nine days.
    path, _first, _second = s.warehouse()
    ledger = landing.read_ledger(s.spark, path)
    early = F.col("file_path").rlike("/month=1/day=[1-9]/")

    def case(name: str, topic: str, files: DataFrame, known: DataFrame) -> DataFrame:
        rows = s.files(topic).select("file_path", "rows")
        known = known.filter(F.col("topic") == topic)
        found = quality.reconcile_files(files, known).select("passed")
        lost = quality.unmatched_files(files, known).join(rows, "file_path")
        return lost.agg(
            F.coalesce(F.sum(F.when(F.col("side") == "lake", F.col("rows"))), F.lit(0)).alias(
                "rows_not_in_ledger"),
            F.coalesce(F.sum(F.when(F.col("side") == "ledger", F.col("rows"))), F.lit(0)).alias(
                "rows_not_in_lake"),
        ).select(
            F.lit(name).alias("case"), F.lit(topic).alias("topic"), "rows_not_in_ledger",
            "rows_not_in_lake", found.scalar().alias("passed"),
        )

    cases = []
    for topic in TOPICS:
        files = s.files(topic)
        cases += [
            case("as loaded", topic, files, ledger),
            case("ledger lacks days", topic, files, ledger.filter(~early)),
            case("lake lacks days", topic, files.filter(~early), ledger),
        ]
    return _union(cases)


@_query("q13_audit_topics")
def _(s: Source) -> DataFrame:
    # All topics of the warehouse that loaded them, and of the one that loaded two.
    path, _first, _second = s.warehouse()
    same = F.col("source_files") == F.col("ledger_files")
    folder = s.lake()
    cases = [
        (name, where, topic)
        for name, where in (("whole", path), ("half", s.half_warehouse()))
        for topic in TOPICS
    ]
    # The audits need nothing of each other: side by side, the short steps of one fill the cores
    # that another leaves.
    with ThreadPoolExecutor(len(TOPICS)) as pool:
        reports = list(pool.map(lambda c: audit_topic(s.spark, folder, c[1], c[2]), cases))
    return _union(
        report.select(
            F.lit(name).alias("warehouse"), "topic", "source_rows", "target_rows", "missing_rows",
            "extra_rows", "schema_differences", same.alias("same_files"), "passed",
        )
        for (name, _, _), report in zip(cases, reports)
    )


@_query("q14_missing_dimensions")
def _(s: Source) -> DataFrame:
    return quality.missing_dimensions(s.int_fact())


for _layer, _checks in {
    "intermediate": declared.INTERMEDIATE, "marts": declared.MARTS, "dashboard": declared.DASHBOARD,
}.items():
    _QUERIES[f"q1_declared_{_layer}"] = (
        lambda s, layer=_layer, checks=_checks: declared.report(s.layer(layer), checks).drop("example")
    )


def queries() -> dict[str, Query]:
    def run(build):
        return lambda spark, sf_dir: naive_times(build(Source(spark, sf_dir)))

    return {name: run(build) for name, build in _QUERIES.items()}


