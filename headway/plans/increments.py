"""Incremental forms of the staged feeds, the golden events and the route metrics."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import schemas
from headway.functions import utc_literal
from headway.operators.upsert import upsert
from headway.plans.delays import (
    DELAY_COUNTS,
    DELAY_OF,
    delay_counts,
    fct_route_delay_daily,
    fct_route_delay_hourly,
    hourly_of_counts,
    signed_counts,
    summed_counts,
    with_day,
)
from headway.plans.events import int_trip_stop_events_deduped
from headway.plans.staging import NEWEST_PING, NEWEST_UPDATE, stg_trip_updates, stg_vehicle_positions
from headway.sources.raw_log import read_raw
from headway.sources.scratch import written
from headway.sources.table import BUCKETS, Pointer, StoredTable, by_day, by_hash

STAGED_UPDATES = "stg_trip_updates"
STAGED_PINGS = "stg_vehicle_positions"
EVENTS = "int_trip_stop_events_deduped"
HOURLY = "fct_route_delay_hourly"
DAILY = "fct_route_delay_daily"
COUNTS = "route_delay_counts"
# Increments whose signed counts the events' pointer names; metrics further behind start again.
KEPT_DELTAS = 64


def staged_updates_table(spark: SparkSession, warehouse: str, buckets: int = BUCKETS) -> StoredTable:
    """Newest prediction per stop event, by bucket of the key: a key names no date, so an event
    may move between days but never between buckets."""
    return StoredTable(
        spark, f"{warehouse}/{STAGED_UPDATES}", schemas.MODELS[STAGED_UPDATES], by_hash("event_key", buckets)
    )


def staged_pings_table(spark: SparkSession, warehouse: str) -> StoredTable:
    """Last copy of every ping, by day. The key holds the time of the ping, so the day follows
    from it; pings of blank vehicles share the null key and a part of their own."""
    day = F.when(F.col("vehicle_event_key").isNotNull(), F.to_date("timestamp").cast("string"))
    return StoredTable(
        spark, f"{warehouse}/{STAGED_PINGS}", schemas.MODELS[STAGED_PINGS], F.coalesce(day, F.lit("blank"))
    )


def stage_updates(table: StoredTable, raw: DataFrame, rebuild: bool = False) -> list[str]:
    """Merges raw predictions; the table equals staging the whole log at once."""
    return upsert(table, stg_trip_updates(raw), "event_key", NEWEST_UPDATE, rebuild)


def stage_pings(table: StoredTable, raw: DataFrame, rebuild: bool = False) -> list[str]:
    """Merges raw pings; the table equals staging the whole log at once."""
    return upsert(table, stg_vehicle_positions(raw), "vehicle_event_key", NEWEST_PING, rebuild)


def stage_new_updates(table: StoredTable, trip_log: str, rebuild: bool = False) -> list[str]:
    """Stages rows from the newest batch held on. That batch is read again, as an append may
    have added to it since."""
    start = None if rebuild else table.mark
    raw = read_raw(table.spark, trip_log, schemas.RAW_TRIP_UPDATES, ingested_from=start)
    return stage_updates(table, raw, rebuild)


def stage_new_pings(table: StoredTable, vehicle_log: str, rebuild: bool = False) -> list[str]:
    start = None if rebuild else table.mark
    raw = read_raw(table.spark, vehicle_log, schemas.RAW_VEHICLE_POSITIONS, ingested_from=start)
    return stage_pings(table, raw, rebuild)


def events_table(spark: SparkSession, warehouse: str, buckets: int = BUCKETS) -> StoredTable:
    """Golden events by bucket of the key; the entity id that settles ties of one poll is kept
    beside them. Its pointer names the signed counts of the last increments."""
    part = by_hash("event_key", buckets)
    return StoredTable(spark, f"{warehouse}/{EVENTS}", schemas.MODELS[EVENTS], part, "entity_id string")


def counts_table(spark: SparkSession, warehouse: str) -> StoredTable:
    """Events per route, hour and delay, by day."""
    return StoredTable(spark, f"{warehouse}/{COUNTS}", DELAY_COUNTS, by_day("date_day"))


def hourly_table(spark: SparkSession, warehouse: str) -> StoredTable:
    return StoredTable(spark, f"{warehouse}/{HOURLY}", schemas.MODELS[HOURLY], by_day("date_day"))


def daily_table(spark: SparkSession, warehouse: str) -> StoredTable:
    return StoredTable(spark, f"{warehouse}/{DAILY}", schemas.MODELS[DAILY], by_day("date_day"))


def apply_raw(events: StoredTable, raw: DataFrame, rebuild: bool = False) -> list[str]:
    """Stages and cleans raw rows and merges them; returns the buckets that changed."""
    return apply_staged(events, stg_trip_updates(raw), rebuild)


def apply_staged(events: StoredTable, staged: DataFrame, rebuild: bool = False, stored: bool = False) -> list[str]:
    """Cleans staged rows and merges them; returns the buckets that changed.

    A key whose newest new row is unusable keeps the row it has, unlike in a rebuild. The
    pointer that makes the merged buckets current also names the signed counts of the change,
    so that the metrics see either both or neither.
    """

    def notes(at: Pointer, accepted: DataFrame | None) -> dict:
        if accepted is None:
            return {"deltas": []}
        folder = events.new_folder(at, "d")
        days, _ = events.write_parts(signed_counts(accepted), folder, by_day("date_day"))
        return {"deltas": [*at.notes.get("deltas", []), [at.version + 1, folder, days]][-KEPT_DELTAS:]}

    rows = int_trip_stop_events_deduped(staged, keep=["entity_id"])
    return upsert(events, rows, "event_key", NEWEST_UPDATE, rebuild, DELAY_OF, notes, stored=stored)


def load_new_events(events: StoredTable, trip_log: str, rebuild: bool = False) -> list[str]:
    """Applies raw rows ingested strictly after the table's newest row; all while it is empty.

    The mark is tested on the raw log, below the newest-per-key step, so old partitions are
    never read. That step orders by ingestion time first, so the rows are the same.
    """
    start = None if rebuild else events.mark
    raw = read_raw(events.spark, trip_log, schemas.RAW_TRIP_UPDATES, ingested_after=start)
    return apply_raw(events, raw, rebuild)


def stage_and_load(staged: StoredTable, events: StoredTable, trip_log: str, rebuild: bool = False) -> None:
    """Both tables as ``stage_new_updates`` and ``load_new_events`` bring them up, from one pass
    over the log.

    The newest rows per key since the earlier of the two marks serve both: as that step orders
    by ingestion time first, those of them after a later mark are the newest rows after that mark.
    """
    spark = staged.spark
    if rebuild or not (staged.pointer().parts or events.pointer().parts):
        stage_updates(staged, read_raw(spark, trip_log, schemas.RAW_TRIP_UPDATES), rebuild)
        apply_staged(events, staged.read(), rebuild)
        return
    marks = staged.mark, events.mark
    start = None if None in marks else min(marks)
    folder = f"{staged.path}/staging/{uuid.uuid4().hex}"
    try:
        newest = written(stg_trip_updates(read_raw(spark, trip_log, schemas.RAW_TRIP_UPDATES, ingested_from=start)), folder)
        at = F.col("ingested_at")
        to_stage, to_load = (
            newest if mark is None else newest.where(since(utc_literal(mark)))
            for mark, since in zip(marks, (at.__ge__, at.__gt__))
        )
        upsert(staged, to_stage, "event_key", NEWEST_UPDATE, stored=True)
        apply_staged(events, to_load, stored=True)
    finally:
        staged._delete(folder)


class Behind(NamedTuple):
    """What a table derived from the events has not seen: the events' version, the folders of
    signed counts, and the days they change; null where it has to start again."""

    version: int
    folders: list[str] | None
    days: list[str] | None


def behind(events: Pointer, derived: StoredTable) -> Behind:
    deltas = events.notes.get("deltas", [])
    seen = derived.pointer().notes.get("seen", -1)
    oldest = deltas[0][0] - 1 if deltas else events.version
    if seen < oldest:
        return Behind(events.version, None, None)
    new = [d for d in deltas if d[0] > seen]
    return Behind(events.version, [d[1] for d in new], sorted({day for d in new for day in d[2]}))


def with_deltas(events: StoredTable, counts: StoredTable, folders: list[str], days: list[str]) -> DataFrame:
    """The counts of the given days after the signed counts in the given folders."""
    held = counts.read(days)
    paths = [f"{events.path}/data/{folder}" for folder in folders]
    changes = counts.spark.read.schema(DELAY_COUNTS).option("basePath", f"{events.path}/data").parquet(*paths)
    return summed_counts(held.unionByName(changes.select(*held.columns)))


def refresh_metrics(
    events: StoredTable, counts: StoredTable, hourly: StoredTable, daily: StoredTable
) -> list[str] | None:
    """Brings counts, hours and days up to the events; returns the days of the hours that
    changed, null if all were built anew.

    Every increment of the events left signed counts: a revised event counts -1 where it was and
    +1 where it is. The counts absorb them, and the changed days' hours come from the
    counts, so no event is read. Each table's pointer notes the events' version it has
    seen, together with its content: a crash between two tables is caught up on the next run
    and no change is counted twice. Only a table that is new, or further behind than the
    changes kept, is built from all events.
    """
    at = events.pointer()
    change = behind(at, counts)
    if change.folders is None:
        all_counts = with_day(delay_counts(events.read(at=at)))
        counts.replace(all_counts, seen=change.version)
    elif change.folders:
        counts.replace(with_deltas(events, counts, change.folders, change.days), change.days, seen=change.version)
    change = behind(at, hourly)
    if change.days is None or change.folders:
        hours = fct_route_delay_hourly(hourly_of_counts(counts.read(change.days).drop("date_day")))
        hourly.replace(hours, change.days, seen=change.version)
    rolled = behind(at, daily)
    if rolled.days is None or rolled.folders:
        daily.replace(fct_route_delay_daily(hourly.read(rolled.days)), rolled.days, seen=rolled.version)
    return change.days
