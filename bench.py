"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each time covers planning and running the whole query into a no-op sink. Layers that later queries
read (staging, dimensions, fact, play table, lake) are written by the first query that needs them
and are timed there, as ``layer_*`` and ``s4_stream_sink``.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cadenza.plans.registered import Source, queries  # noqa: E402
from cadenza.schemas import TOPICS  # noqa: E402
from cadenza.session import build_session  # noqa: E402

LAYERS = {
    "layer_staging": lambda s: [s.stg(t) for t in TOPICS],
    "layer_dimensions": lambda s: [
        s.int_dim(f"dim_{n}") for n in ("date", "time", "song", "location", "session", "user")
    ],
    "layer_fact": lambda s: s.int_fact(),
    "layer_song_plays": lambda s: s.song_plays(),
}

HEADLINE = [
    "t2_stg_listen_events", "d2_int_dim_time", "d6_int_dim_song", "d11_int_dim_user",
    "f2_next_event", "f6_scd2_lookup", "f7_song_lookup", "f12_int_fact_song_play",
    "m1_dim_user", "m13_changed_rows", "m14_upsert", "p1_song_plays",
    "r3_summary", "r5_top_songs", "r6_top_song_per_gender", "r7_heatmap", "r8_daily_trend",
    "r13_report_bundle", "q4_relationships", "q9_fact_not_preserved",
    "s2_decode", "s4_stream_sink", "s8_landing_rows", "q12_reconcile_rows",
    "q12_reconcile_lineitem",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The JVM starts and the files are listed before anything is timed.
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()

    times: dict[str, float] = {}

    def timed(name, work) -> None:
        start = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - start, 3)

    source = Source(spark, sf_dir)
    for name, build in LAYERS.items():
        timed(name, lambda build=build: build(source))
    registered = queries()
    for name in HEADLINE:
        timed(
            name,
            lambda name=name: registered[name](spark, sf_dir).write.format("noop").mode(
                "overwrite"
            ).save(),
        )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "event_rows": rows,
            }
        )
    )


if __name__ == "__main__":
    main()
