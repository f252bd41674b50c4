"""What the live mart needs of both feeds, kept as small tables.

Per feed there are two: the newest copies that can still decide, and a snapshot of one row per
trip or vehicle made from them. Both have the same buckets, so a change touches the same
parts of both, and a refresh reads no staged history.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.functions import utc_literal
from headway.operators.latest import latest_per_key
from headway.operators.upsert import upsert
from headway.plans.fleet import latest_delays, latest_positions, live_of
from headway.plans.staging import NEWEST_PING, NEWEST_UPDATE
from headway.sources.table import BUCKETS, Pointer, StoredTable, by_hash

PREDICTIONS = (
    "event_key string, trip_id string, delay_sec int, ingested_at timestamp_ntz, feed_timestamp timestamp_ntz, "
    "event_time timestamp_ntz, entity_id string"
)
TRIP_DELAYS = "trip_id string, delay_sec int"
PINGS = (
    "vehicle_event_key string, vehicle_id string, trip_id string, route_id string, position_lat double, "
    "position_lon double, bearing double, speed double, timestamp timestamp_ntz, ingested_at timestamp_ntz, "
    "feed_timestamp timestamp_ntz, entity_id string, seen_at timestamp_ntz"
)
POSITIONS = (
    "vehicle_id string, trip_id string, route_id string, position_lat double, position_lon double, bearing double, "
    "speed double, last_updated_at timestamp_ntz"
)


def predictions_table(spark: SparkSession, warehouse: str, buckets: int = BUCKETS) -> StoredTable:
    """Newest prediction per stop event; keys name no date, so it is as large as the timetable."""
    return StoredTable(spark, f"{warehouse}/live_predictions", PREDICTIONS, by_hash("trip_id", buckets))


def trip_delays_table(spark: SparkSession, warehouse: str, buckets: int = BUCKETS) -> StoredTable:
    return StoredTable(spark, f"{warehouse}/live_trip_delays", TRIP_DELAYS, by_hash("trip_id", buckets))


def pings_table(spark: SparkSession, warehouse: str, buckets: int = BUCKETS) -> StoredTable:
    """Pings young enough for another copy to come, and each vehicle's newest position before."""
    return StoredTable(spark, f"{warehouse}/live_pings", PINGS, by_hash("vehicle_id", buckets))


def positions_table(spark: SparkSession, warehouse: str, buckets: int = BUCKETS) -> StoredTable:
    return StoredTable(spark, f"{warehouse}/live_positions", POSITIONS, by_hash("vehicle_id", buckets))


def columns(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _refresh(snapshot: StoredTable, source: StoredTable, one_row_each, touched: list[str]) -> None:
    """Rewrites the touched parts of a snapshot; all of them where it has missed a change,
    as after a crash between the two tables."""
    at = source.pointer()
    seen = snapshot.pointer().notes.get("seen")
    if seen == at.version:
        return
    parts = touched if seen == at.version - 1 else None
    snapshot.replace(one_row_each(source.read(parts, at=at)), parts, seen=at.version)


def apply_predictions(predictions: StoredTable, delays: StoredTable, newest: DataFrame) -> None:
    """Takes over newest predictions (one row per event key) and their trips' delays."""
    touched = upsert(predictions, newest.select(*columns(PREDICTIONS)), "event_key", NEWEST_UPDATE)
    _refresh(delays, predictions, latest_delays, touched)


def seen_at() -> Column:
    """Time of a ping, at most that of its arrival: a clock that runs ahead must not make all
    other pings late."""
    return F.least("timestamp", "ingested_at")


def without_settled(pings: DataFrame, horizon: dt.datetime | str | None) -> DataFrame:
    """Drops pings that can decide nothing any more: before the horizon no copy is accepted, so
    of the pings before it only a vehicle's newest position counts."""
    if horizon is None:
        return pings
    settled = F.col("seen_at") < utc_literal(horizon)
    position = F.col("position_lat").isNotNull() & F.col("position_lon").isNotNull()
    by_age = Window.partitionBy("vehicle_id", "is_settled", "is_position").orderBy(F.desc("timestamp"))
    ranked = pings.withColumns({"is_settled": settled, "is_position": position}).withColumn("rank", F.row_number().over(by_age))
    return ranked.where(~F.col("is_settled") | (F.col("is_position") & (F.col("rank") == 1))).select(*pings.columns)


def horizon_of(at: Pointer, lateness: dt.timedelta) -> dt.datetime | None:
    """The time before which nothing is accepted, by what the table held so far."""
    newest = at.notes.get("newest")
    return None if newest is None else dt.datetime.fromisoformat(newest) - lateness


def apply_pings(pings: StoredTable, positions: StoredTable, newest: DataFrame, lateness: dt.timedelta) -> None:
    """Takes over last copies of pings and their vehicles' positions."""
    one_each = latest_per_key(newest.select(*columns(PINGS)), ["vehicle_event_key"], [F.desc(c) for c in NEWEST_PING])
    touched = upsert(
        pings,
        one_each,
        "vehicle_event_key",
        NEWEST_PING,
        highest={"newest": "seen_at"},
        trimmed=lambda at, rows: without_settled(rows, horizon_of(at, lateness)),
    )
    _refresh(positions, pings, latest_positions, touched)


def live_fleet(spark: SparkSession, warehouse: str, as_of=None) -> DataFrame:
    """The live mart from the two snapshots; equal to the batch model."""
    return live_of(positions_table(spark, warehouse).read(), trip_delays_table(spark, warehouse).read(), as_of)
