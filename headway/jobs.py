"""Command line for spark-submit: ingest feeds, build models, run the checks.

    spark-submit headway/jobs.py ingest --trip-feed F --vehicle-feed F --trip-log L --vehicle-log L
    spark-submit headway/jobs.py build  --trip-log L --vehicle-log L --warehouse W [--tag T ...]
    spark-submit headway/jobs.py test   --trip-log L --vehicle-log L --warehouse W
    spark-submit headway/jobs.py follow --trip-log L --warehouse W --progress P [--every "20 minutes"]
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from headway import schemas
from headway.plans.pipeline import Project
from headway.session import build_session
from headway.sources.feeds import read_feed
from headway.sources.ingest import run_ingest
from headway.streaming.feeds import stream_trip_feed, stream_vehicle_feed
from headway.streaming.fleet import (
    FreshnessMonitor,
    stream_positions,
    stream_staged_pings,
    stream_staged_updates,
    stream_trip_delays,
)
from headway.streaming.route_metrics import stream_route_metrics


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    options = {"multiLine": True} if args.multi_line else {}
    trips = read_feed(spark, args.trip_feed, schemas.TRIP_FEED, args.format, **options)
    vehicles = read_feed(spark, args.vehicle_feed, schemas.VEHICLE_FEED, args.format, **options)
    counts = run_ingest(trips, vehicles, args.trip_log, args.vehicle_log)
    print(*(f"{name}={count}" for name, count in counts.items()))


def build(spark: SparkSession, args: argparse.Namespace) -> None:
    project = Project(spark, args.trip_log, args.vehicle_log, args.warehouse)
    built = project.build(tags=args.tag or None, full_refresh=args.full_refresh)
    print("built", *built)


def test(spark: SparkSession, args: argparse.Namespace) -> None:
    project = Project(spark, args.trip_log, args.vehicle_log, args.warehouse)
    for row in project.test().collect():
        print("pass" if row.failures == 0 else f"fail {row.failures}", row.model, row.column, row.test)
    for row in project.source_freshness().collect():
        print(row.status, row.source_table, "age", row.age_minutes, "minutes")


def follow(spark: SparkSession, args: argparse.Namespace) -> None:
    """Both logs into the staged feeds, the live fleet, the events and the metrics, each stream
    with its own progress."""
    run = args.trip_log, args.warehouse
    monitor = FreshnessMonitor(spark, args.warehouse)
    spark.streams.addListener(monitor)
    streams = [stream_route_metrics(spark, *run, f"{args.progress}/metrics", args.every)]
    if args.vehicle_log:
        pings = args.vehicle_log, args.warehouse
        streams.append(stream_staged_updates(spark, *run, f"{args.progress}/updates", args.every))
        streams.append(stream_staged_pings(spark, *pings, f"{args.progress}/pings", args.every))
        streams.append(stream_trip_delays(spark, *run, f"{args.progress}/delays", args.every))
        streams.append(stream_positions(spark, *pings, f"{args.progress}/positions", args.every))
    for stream in streams:
        stream.awaitTermination()
        monitor.wait(stream)
    spark.streams.removeListener(monitor)


def receive(spark: SparkSession, args: argparse.Namespace) -> None:
    """Landed feed files of both kinds into the raw logs."""
    streams = [
        stream_trip_feed(spark, args.trip_feed, args.trip_log, f"{args.progress}/trips", args.every),
        stream_vehicle_feed(spark, args.vehicle_feed, args.vehicle_log, f"{args.progress}/vehicles", args.every),
    ]
    for stream in streams:
        stream.awaitTermination()


def clean(spark: SparkSession, args: argparse.Namespace) -> None:
    Project(spark, "", "", args.warehouse).drop_old_versions(args.keep)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="headway")
    commands = top.add_subparsers(required=True)

    def command(run, *required: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(run.__name__)
        sub.set_defaults(run=run)
        for name in required:
            sub.add_argument(f"--{name}", required=True)
        return sub

    sub = command(ingest, "trip-feed", "vehicle-feed", "trip-log", "vehicle-log")
    sub.add_argument("--format", default="json", choices=("json", "parquet"))
    sub.add_argument("--multi-line", action="store_true", help="one JSON message over several lines per file")
    sub = command(receive, "trip-feed", "vehicle-feed", "trip-log", "vehicle-log", "progress")
    sub.add_argument("--every")
    sub = command(clean, "warehouse")
    sub.add_argument("--keep", type=int, default=3)
    sub = command(build, "trip-log", "vehicle-log", "warehouse")
    sub.add_argument("--tag", action="append")
    sub.add_argument("--full-refresh", action="store_true")
    command(test, "trip-log", "vehicle-log", "warehouse")
    sub = command(follow, "trip-log", "warehouse", "progress")
    sub.add_argument("--vehicle-log")
    sub.add_argument("--every")
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(spark or build_session(), args)


if __name__ == "__main__":
    main()
