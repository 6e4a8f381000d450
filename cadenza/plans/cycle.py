"""One warehouse cycle: ingest, staging, intermediate, marts, dashboard, with checks after each.

Checks of single rows are counted by the writes that store the tables, checks of keys by one grouped
count a layer (``declared.py``); what each layer's checks found is stored as its ``checks`` table.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from cadenza.operators import dashboard, declared, dimensions, fact, history, marts, quality, staging
from cadenza.operators.ordered import Chunks, chunk_seconds_for, chunks_for
from cadenza.schemas import TOPICS
from cadenza.session import prepare, size_shuffles
from cadenza.sources.increments import extend_history, extend_staging
from cadenza.sources.landing import run_ingestion
from cadenza.sources.paths import stored_bytes
from cadenza.sources.tables import materialise, store_fact, watched


def build_staging(
    landing: dict[str, DataFrame], warehouse: str, kind: str = "table"
) -> dict[str, DataFrame]:
    """Written once, because eight later steps read it and a view would repeat the casts and the
    distinct for each; ``kind="view"`` keeps it unwritten."""
    return {
        topic: materialise(
            staging.stage(landing[topic], topic), warehouse, "staging", f"stg_{topic}", kind
        )
        for topic in TOPICS
    }


def user_chunks(stg: dict[str, DataFrame], warehouse: str) -> Chunks:
    """Chunks of the users' events for this data, with cuts where a user has a burst of them."""
    events = reduce(DataFrame.unionByName, [df.select("userId", "ts") for df in stg.values()])
    return chunks_for(
        events, "userId", "ts", chunk_seconds_for(stg["page_view_events"]),
        keep=lambda cuts: materialise(cuts, warehouse, "intermediate", "hot_chunks"),
    )


def build_intermediate(
    stg: dict[str, DataFrame], warehouse: str, users: DataFrame | None = None
) -> dict[str, DataFrame]:
    """``users``: the user dimension if it is kept up to date elsewhere."""
    listen, page_view = stg["listen_events"], stg["page_view_events"]
    seconds = user_chunks(stg, warehouse)
    fact.reject_conflicts(fact.event_ids(listen, page_view))
    plans = {
        "int_dim_date": dimensions.int_dim_date(listen),
        "int_dim_time": dimensions.int_dim_time(listen),
        "int_dim_song": dimensions.int_dim_song(listen),
        "int_dim_location": dimensions.int_dim_location(page_view),
        "int_dim_session": dimensions.int_dim_session(page_view),
        "int_dim_user": users or history.int_dim_user(
            stg["auth_events"], listen, page_view, stg["status_change_events"], seconds
        ),
    }
    built = {n: _checked(df, warehouse, "intermediate", n) for n, df in plans.items()}
    plays = fact.int_fact_song_play(
        listen,
        page_view,
        dates=built["int_dim_date"],
        times=built["int_dim_time"],
        users=built["int_dim_user"],
        songs=built["int_dim_song"],
        locations=built["int_dim_location"],
        sessions=built["int_dim_session"],
        disjoint=True,  # periods end where the next one starts
        seconds=seconds,
    )
    built["int_fact_song_play"] = _checked(plays, warehouse, "intermediate", "int_fact_song_play")
    return built


LAYERS = {
    "intermediate": declared.INTERMEDIATE, "marts": declared.MARTS, "dashboard": declared.DASHBOARD,
}


def _checked(
    df: DataFrame, warehouse: str, layer: str, name: str, day: str | None = None
) -> DataFrame:
    """A stored table whose checks of single rows are counted as it is written."""
    return materialise(
        df, warehouse, layer, name, day=day, watch=declared.row_checks(LAYERS[layer], name)
    )


def check_layer(
    tables: dict[str, DataFrame],
    warehouse: str,
    layer: str,
    extra: dict[str, DataFrame],
    tolerate: Collection[str],
) -> None:
    """All declared checks of a layer and some more (violating rows by name). The outcome is stored
    first, as ``<layer>/checks``; then violations stop the cycle, but for those tolerated."""
    checks = LAYERS[layer]
    spark = next(iter(tables.values())).sparkSession
    counted = {n: watched(spark, warehouse, layer, n) for n in {c.table for c in checks}}
    seen = {name: n for found in counted.values() for name, n in found.items()}
    # A table that is not written as a whole (the incremental fact) is read for its checks.
    unseen = {n: tables[n] for n, found in counted.items() if not found}
    found = declared.watched_checks(spark, seen).unionByName(declared.key_checks(tables, checks))
    if unseen:
        found = found.unionByName(declared.scanned_checks(unseen, checks))
    for name, violations in extra.items():
        row = violations.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("name"), "violations", F.lit(None).cast("string").alias("example")
        )
        found = found.unionByName(row)
    declared.enforce(materialise(found, warehouse, layer, "checks"), tolerate)


def check_intermediate(
    built: dict[str, DataFrame], warehouse: str, tolerate: Collection[str] = ()
) -> None:
    rows = built["int_fact_song_play"]
    extra = {"int_fact_song_play duration": quality.bad_durations(rows)}
    check_layer(built, warehouse, "intermediate", extra, tolerate)
    # Plays without a dimension row are no violation; the numbers are kept to be watched.
    materialise(quality.missing_dimensions(rows), warehouse, "intermediate", "missing_dimensions")


def build_marts(
    built: dict[str, DataFrame], warehouse: str, run_ts: datetime | str
) -> dict[str, DataFrame]:
    result = {}
    for dim in marts.DIMENSIONS:
        source = built[f"int_{dim.name}"]
        marts.reject_bad_keys(source, dim)
        result[dim.name] = _checked(
            marts.build_dimension(source, dim, run_ts), warehouse, "marts", dim.name
        )
    result["fact_song_play"] = store_fact(built["int_fact_song_play"], warehouse, run_ts)
    return result


def check_marts(
    built: dict[str, DataFrame],
    result: dict[str, DataFrame],
    warehouse: str,
    tolerate: Collection[str] = (),
) -> None:
    extra = {
        f"{dim.name} Unknown": quality.bad_unknown_member(
            built[f"int_{dim.name}"], result[dim.name], dim
        )
        for dim in marts.DIMENSIONS
    }
    extra["marts audit"] = quality.bad_audit(result)
    extra["fact_song_play preserved"] = quality.fact_not_preserved(
        built["int_fact_song_play"], result["fact_song_play"]
    )
    check_layer(result, warehouse, "marts", extra, tolerate)


def build_dashboard(result: dict[str, DataFrame], warehouse: str) -> dict[str, DataFrame]:
    locations, users = result["dim_location"], result["dim_user"]
    plans = {
        "song_plays": dashboard.song_plays(
            result["fact_song_play"], locations, users, result["dim_song"]
        ),
        "filter_options": dashboard.filter_options(locations, users),
    }
    days = {"song_plays": "play_date"}
    return {n: _checked(df, warehouse, "dashboard", n, days.get(n)) for n, df in plans.items()}


def check_dashboard(
    result: dict[str, DataFrame],
    boards: dict[str, DataFrame],
    warehouse: str,
    tolerate: Collection[str] = (),
) -> None:
    extra = {
        "song_plays preserved": quality.dashboard_not_preserved(
            result["fact_song_play"], boards["song_plays"]
        )
    }
    check_layer(boards, warehouse, "dashboard", extra, tolerate)


def build_warehouse(
    spark: SparkSession,
    landing: dict[str, DataFrame],
    warehouse: str,
    run_ts: datetime | str | None = None,
    tolerate: Collection[str] = (),
) -> dict[str, DataFrame]:
    """Landing to dashboard. A layer whose checks fail stops the cycle, with all of them named;
    ``tolerate`` names checks that only count."""
    prepare(spark)
    return _build(build_staging(landing, warehouse), None, warehouse, run_ts, tolerate)


def _build(
    stg: dict[str, DataFrame],
    users: DataFrame | None,
    warehouse: str,
    run_ts: datetime | str | None,
    tolerate: Collection[str],
) -> dict[str, DataFrame]:
    run_ts = run_ts or datetime.now(timezone.utc).replace(tzinfo=None)
    built = build_intermediate(stg, warehouse, users)
    check_intermediate(built, warehouse, tolerate)
    result = build_marts(built, warehouse, run_ts)
    check_marts(built, result, warehouse, tolerate)
    boards = build_dashboard(result, warehouse)
    check_dashboard(result, boards, warehouse, tolerate)
    return {**built, **result, **boards}


def run_cycle(
    spark: SparkSession,
    lake_dir: str,
    warehouse: str,
    run_ts: datetime | str | None = None,
    tolerate: Collection[str] = (),
) -> tuple[dict[str, int], dict[str, DataFrame]]:
    """Ingest what is new, extend staging and the user history by it, and build the rest from them.
    Returns loaded rows per topic and the tables."""
    prepare(spark)
    loaded = run_ingestion(spark, lake_dir, warehouse)
    size_shuffles(spark, stored_bytes(spark, f"{warehouse}/landing"))
    stg = {topic: extend_staging(spark, warehouse, topic) for topic in TOPICS}
    users = extend_history(spark, warehouse, user_chunks(stg, warehouse))
    return loaded, _build(stg, users, warehouse, run_ts, tolerate)
