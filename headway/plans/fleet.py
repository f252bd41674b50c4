"""Live fleet: newest position per vehicle with its trip's newest delay."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions import whole_minutes_between
from headway.functions.clock import as_of_column
from headway.operators.latest import latest_per_key


def latest_positions(pings: DataFrame) -> DataFrame:
    """Newest ping with coordinates per vehicle; pings without them are skipped, not shown."""
    located = pings.where(F.col("position_lat").isNotNull() & F.col("position_lon").isNotNull()).select(
        "vehicle_id",
        "trip_id",
        "route_id",
        "position_lat",
        "position_lon",
        "bearing",
        "speed",
        F.col("timestamp").alias("last_updated_at"),
    )
    return latest_per_key(located, ["vehicle_id"], [F.desc("last_updated_at")])


def latest_delays(staged: DataFrame) -> DataFrame:
    """Newest known delay per trip.

    All stops of a trip arrive in one batch, so the batch times tie; the latest event and
    then the event key settle which stop is shown.
    """
    known = staged.where(F.col("trip_id").isNotNull() & F.col("delay_sec").isNotNull()).select(
        "trip_id", "delay_sec", "ingested_at", "feed_timestamp", "event_time", "event_key"
    )
    order = [F.desc("ingested_at"), F.desc("feed_timestamp"), F.desc("event_time"), F.asc("event_key")]
    return latest_per_key(known, ["trip_id"], order).select("trip_id", "delay_sec")


def fct_latest_vehicle_positions(
    pings: DataFrame, staged: DataFrame, as_of: Column | dt.datetime | str | None = None
) -> DataFrame:
    """Positions with minutes since the last ping and the delay, 0 when none is known."""
    return live_of(latest_positions(pings), latest_delays(staged), as_of)


def live_of(
    positions: DataFrame, delays: DataFrame, as_of: Column | dt.datetime | str | None = None
) -> DataFrame:
    """The live mart from one row per vehicle and one row per trip."""
    # The key of a vehicle without trip matches nothing and differs per vehicle, so those
    # vehicles spread over all partitions. Deriving the key on both sides also puts a shuffle
    # right below both, which AQE needs to split a trip that holds many vehicles.
    of_trip = F.concat(F.lit("t"), F.col("trip_id"))
    of_vehicle = F.concat(F.lit("v"), F.col("vehicle_id"))
    delays = delays.select(of_trip.alias("join_key"), "delay_sec")
    return (
        positions.withColumn("join_key", F.coalesce(of_trip, of_vehicle))
        .join(delays, "join_key", "left")
        .select(
            "vehicle_id",
            "trip_id",
            "route_id",
            "position_lat",
            "position_lon",
            "bearing",
            "speed",
            "last_updated_at",
            whole_minutes_between(F.col("last_updated_at"), as_of_column(as_of)).alias("minutes_since_update"),
            F.coalesce("delay_sec", F.lit(0)).alias("current_delay_sec"),
        )
    )
