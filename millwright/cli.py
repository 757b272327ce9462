"""Command line: archive queries, dashboards, the continuous jobs and the scheduled ones.

    python -m millwright.cli archive ROOT                        list the tables
    python -m millwright.cli archive ROOT --table line_events    first rows of a table
    python -m millwright.cli archive ROOT --table T --time-travel
    python -m millwright.cli archive ROOT --table T --as-of-snapshot 3
    python -m millwright.cli archive ROOT --oee
    python -m millwright.cli job oee --servers HOST:9092 --out PATH --checkpoint PATH
    python -m millwright.cli job alerts --folder DIR --growing --distinct --progress PATH --out PATH --checkpoint PATH
    python -m millwright.cli refresh --metrics PATH --hourly PATH          hourly rollup, run it every half hour
    python -m millwright.cli retention --metrics PATH --archive ROOT       drop what is past its time
    python -m millwright.cli compact --archive ROOT                        rewrite finished days, run it daily
    python -m millwright.cli dashboard current --metrics PATH              panels over the stored tables

Submit with spark-submit to run on a cluster.
"""

from __future__ import annotations

import argparse
from contextlib import nullcontext
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from millwright import schemas
from millwright.operators.rollups import production_quality
from millwright.plans import serving
from millwright.session import build_session
from millwright.sinks import archive, compaction, tables
from millwright.sources import feeds, message_log
from millwright.streaming import jobs
from millwright.streaming.progress import ProgressLog

_JOB_TOPICS = {
    "oee": "line-events",
    "cpk": "quality-metrics",
    "alerts": "equipment-status",
    "intervals": "equipment-status",
    "bursts": "equipment-status",
}


def archive_query(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    if options.oee:
        return production_quality(
            archive.scan(
                spark, options.root, "line_events", where=f"event_type = '{schemas.CYCLE}'"
            )
        )
    if options.table is None:
        return archive.list_tables(spark, options.root)
    if options.time_travel:
        return archive.snapshots(spark, options.root, options.table).orderBy("snapshot_id")
    return archive.scan(
        spark,
        options.root,
        options.table,
        as_of_snapshot=options.as_of_snapshot,
        limit=options.limit,
    )


def start_job(spark: SparkSession, options: argparse.Namespace):
    """Starts one continuous job; the archive job starts one query per topic."""
    bound = "maxOffsetsPerTrigger" if options.servers else "maxFilesPerTrigger"
    limits = {} if options.at_most is None else {bound: str(options.at_most)}

    def events(topic: str) -> DataFrame:
        table = schemas.TOPICS[topic][0]
        messages = (
            feeds.topic_feed(spark, topic, options.servers, **limits)
            if options.servers
            else message_log.message_feed(spark, f"{options.folder}/{topic}")
            if options.growing
            else feeds.text_feed(spark, f"{options.folder}/{topic}", **limits)
        )
        return feeds.decode(messages, table)

    if options.name == "archive":
        archive.ensure_tables(spark, options.out)
        return [
            jobs.run_archive(
                events(topic), options.out, table, f"{options.checkpoint}/{table}", once=options.once
            )
            for topic, (table, _) in schemas.TOPICS.items()
        ]
    topic = _JOB_TOPICS[options.name]
    rows = feeds.with_defaults(events(topic), schemas.TOPICS[topic][0])
    start = {
        "oee": jobs.run_oee, "cpk": jobs.run_cpk, "alerts": jobs.run_alerts, "intervals": jobs.run_intervals, "bursts": jobs.run_bursts,
    }[options.name]
    return [start(rows, options.out, options.checkpoint, distinct=options.distinct, name=options.name, once=options.once)]


def refresh(spark: SparkSession, options: argparse.Namespace) -> None:
    """One run of the scheduled rollup over the stored windows."""
    as_of = options.as_of
    run = tables.refresh_changed if options.changed else tables.refresh_hourly
    run(spark, options.metrics, options.hourly, as_of, batch=f"{as_of:%Y%m%d%H%M%S}")


def retention(spark: SparkSession, options: argparse.Namespace) -> list[str]:
    """Drops expired hours of a metric table and expired days of the archive; returns what was dropped."""
    dropped = []
    if options.metrics:
        dropped += tables.apply_retention(spark, options.metrics, options.as_of)
    if options.archive:
        for table in schemas.EVENT_TABLES:
            dropped += archive.apply_archive_retention(spark, options.archive, table, options.as_of)
    return dropped


def compact(spark: SparkSession, options: argparse.Namespace) -> list[str]:
    """Compacts the finished days of the archive; returns the days that had something to take in."""
    before = options.as_of - timedelta(hours=options.wait_hours)
    return [
        f"{table} {day}"
        for table in schemas.EVENT_TABLES
        for day in compaction.compact_days(spark, options.archive, table, before)
    ]


def dashboard(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    """A panel over the stored windows; only the hours it shows are opened."""
    start = options.as_of - timedelta(hours=options.hours)
    rows = tables.read_between(spark, options.metrics, schemas.OEE_METRICS, start, options.as_of)
    panels = {
        "current": lambda: serving.current_oee(rows),
        "trend": lambda: serving.trend(rows, "oee", factor=100),
        "worst": lambda: serving.worst_windows(rows),
        "daily": lambda: serving.daily_trend(rows),
    }
    return panels[options.panel]()


def _moment(text: str) -> datetime:
    return datetime.fromisoformat(text)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millwright")
    commands = top.add_subparsers(dest="command", required=True)

    query = commands.add_parser("archive", help="query the event archive")
    query.add_argument("root")
    query.add_argument("--table", choices=list(schemas.EVENT_TABLES))
    query.add_argument("--time-travel", action="store_true", help="show the table's snapshots")
    query.add_argument("--as-of-snapshot", type=int)
    query.add_argument("--oee", action="store_true", help="units and quality per line")
    query.add_argument("--limit", type=int, default=20)

    job = commands.add_parser("job", help="run a continuous job")
    job.add_argument("name", choices=[*_JOB_TOPICS, "archive"])
    source = job.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--folder", help="folder with one folder of JSON lines per topic")
    job.add_argument("--out", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--once", action="store_true", help="process what is there, then stop")
    job.add_argument("--distinct", action="store_true", help="count repeated deliveries of an event once")
    job.add_argument("--progress", help="folder for the table of what the queries report of themselves")
    job.add_argument("--growing", action="store_true", help="the folder holds append-only files: read them by offset")
    job.add_argument("--at-most", type=int, help="messages, or files, per micro-batch: bounds a backlog")

    now = datetime.now(UTC).replace(tzinfo=None)
    rollup = commands.add_parser("refresh", help="refresh the hourly rollup")
    rollup.add_argument("--metrics", required=True)
    rollup.add_argument("--hourly", required=True)
    rollup.add_argument("--changed", action="store_true", help="all hours that have changed, not only the last three")
    expiry = commands.add_parser("retention", help="drop data past its time")
    expiry.add_argument("--metrics")
    expiry.add_argument("--archive")
    tidy = commands.add_parser("compact", help="rewrite finished days of the archive as sorted files")
    tidy.add_argument("--archive", required=True)
    tidy.add_argument("--wait-hours", type=float, default=1.0, help="leave a day alone for so long after its end")
    panel = commands.add_parser("dashboard", help="show a panel")
    panel.add_argument("panel", choices=["current", "trend", "worst", "daily"])
    panel.add_argument("--metrics", required=True)
    panel.add_argument("--hours", type=float, default=3.0)
    for command in (rollup, expiry, tidy, panel):
        command.add_argument("--as-of", type=_moment, default=now, help="UTC, by default now")
    return top


def main(arguments: list[str] | None = None) -> None:
    options = parser().parse_args(arguments)
    spark = build_session()
    if options.command == "archive":
        found = archive_query(spark, options)
        if options.table and not options.time_travel:
            total = archive.scan(
                spark, options.root, options.table, as_of_snapshot=options.as_of_snapshot
            ).count()
            print(f"total rows: {total}")
        found.show(options.limit, truncate=False)
        return
    if options.command == "refresh":
        refresh(spark, options)
    elif options.command == "retention":
        print("\n".join(retention(spark, options)))
    elif options.command == "compact":
        print("\n".join(compact(spark, options)))
    elif options.command == "dashboard":
        dashboard(spark, options).show(1000, truncate=False)
    else:
        log = ProgressLog(spark, options.progress) if options.progress else nullcontext()
        with log:
            for query in start_job(spark, options):
                query.awaitTermination()


if __name__ == "__main__":
    main()
