"""Jobs: ``spark-submit`` or ``python -m cadenza <job> ...``; all settings are arguments."""

from __future__ import annotations

import argparse
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from cadenza.operators import reports
from cadenza.plans.audit import audit_topic
from cadenza.plans.cycle import run_cycle
from cadenza.schemas import TOPICS
from cadenza.session import build_session, shared_dir
from cadenza.sources import landing, messages
from cadenza.sources.tables import is_written, read_table, table_path
from cadenza.streaming import sink
from cadenza.streaming.kafka import STARTING


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="cadenza", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("stream", help="Kafka topics into the lake, until stopped")
    job.add_argument("--servers", required=True)
    job.add_argument("--lake", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--format", default="parquet")
    job.add_argument("--trigger", default=sink.TRIGGER)
    job.add_argument("--starting", default=STARTING, help="offsets a new query starts from")
    job.add_argument("--max-offsets", type=int, help="most offsets of a trigger; default: all")

    job = jobs.add_parser("ingest", help="new lake files into the landing tables")
    job.add_argument("--lake", required=True)
    job.add_argument("--warehouse", required=True)
    job.add_argument("--topic", action="append", choices=TOPICS)

    job = jobs.add_parser("cycle", help="ingest, then rebuild all layers with their checks")
    job.add_argument("--lake", required=True)
    job.add_argument("--warehouse", required=True)
    job.add_argument(
        "--tolerate", action="append", default=[], metavar="CHECK",
        help="a check that is counted but does not stop the run, as 'table.column not_null'",
    )

    job = jobs.add_parser("report", help="the seven reports for one selection")
    job.add_argument("--warehouse", required=True)
    job.add_argument("--start", required=True, type=date.fromisoformat)
    job.add_argument("--end", required=True, type=date.fromisoformat)
    job.add_argument("--state", action="append", default=[])
    job.add_argument("--gender", action="append", default=[])
    job.add_argument("--out", help="folder for the reports; without it they are printed")

    job = jobs.add_parser("audit", help="lake against landing, rows and files, by topic")
    job.add_argument("--lake", required=True)
    job.add_argument("--warehouse", required=True)
    job.add_argument("--topic", action="append", choices=TOPICS)

    job = jobs.add_parser("produce", help="JSON lines into a Kafka topic, keyed by user")
    job.add_argument("--folder", required=True)
    job.add_argument("--servers", required=True)
    job.add_argument("--topic", required=True)
    return parser


#: The check whose stored outcome tells that no play repeats or lacks its key.
_SOUND = ["song_plays.play_key unique", "song_plays.play_key not_null"]


def stored_dashboard(spark: SparkSession, warehouse: str) -> tuple[DataFrame, DataFrame]:
    """The two dashboard tables, refused if one is missing or a play repeats. What the cycle found
    when it stored them is read, not counted again."""
    names = ("song_plays", "filter_options", "checks")
    plays, options, checks = (
        read_table(spark, warehouse, "dashboard", name)
        if is_written(spark, table_path(warehouse, "dashboard", name))
        else None
        for name in names
    )
    sound = None
    if checks is not None:
        found = checks.filter(checks["name"].isin(_SOUND)).collect()
        sound = len(found) == len(_SOUND) and not any(r["violations"] for r in found)
    reports.reject_bad_tables(plays, options, sound)
    return plays, options


def _kept(groups: DataFrame) -> DataFrame:
    """The groups of a report, written to the shared folder and read back."""
    path = f"{shared_dir(groups.sparkSession)}/reports/{uuid.uuid4().hex}"
    groups.write.parquet(path)
    return groups.sparkSession.read.schema(groups.schema).parquet(path)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"cadenza-{args.job}")
    if args.job == "stream":
        sink.run_from_kafka(
            spark,
            args.servers,
            args.lake,
            args.checkpoint,
            args.starting,
            args.max_offsets,
            fmt=args.format,
            trigger=args.trigger,
        )
    elif args.job == "ingest":
        print(landing.run_ingestion(spark, args.lake, args.warehouse, args.topic))
    elif args.job == "cycle":
        loaded, _ = run_cycle(spark, args.lake, args.warehouse, tolerate=args.tolerate)
        print(loaded)
    elif args.job == "report":
        plays, _ = stored_dashboard(spark, args.warehouse)
        plays = reports.days_of(plays, args.start, args.end)
        found = reports.load_report(
            plays, args.start, args.end, args.state, args.gender, keep=_kept
        )
        for name, df in found.items():
            if args.out:
                df.write.mode("overwrite").json(f"{args.out}/{name}")
                continue
            print(name)
            for row in df.toLocalIterator():
                print(row.asDict())
    elif args.job == "audit":
        failed = []
        for topic in args.topic or TOPICS:
            found = audit_topic(spark, args.lake, args.warehouse, topic).first()
            print(found.asDict())
            if not found["passed"]:
                failed.append(topic)
        if failed:
            raise SystemExit(f"lake and landing differ: {', '.join(failed)}")
    else:
        lines = messages.read_lines(spark, args.folder)
        messages.publish(messages.keyed_messages(lines), args.servers, args.topic)


if __name__ == "__main__":
    main()
