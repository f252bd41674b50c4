"""Cleaned feeds, one row per stop event and one row per vehicle ping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions import clean_text, has_text, stop_event_key, trimmed, vehicle_ping_key
from headway.operators.latest import latest_per_key

# The event types kept.
EVENT_TYPES = ("ARRIVAL", "DEPARTURE")

# Newest first. Ingestion and feed time alone leave ties (one trip calling twice at a stop
# within one poll), so the columns after them make the order total.
NEWEST_UPDATE = ("ingested_at", "feed_timestamp", "event_time", "entity_id")
NEWEST_PING = ("ingested_at", "feed_timestamp", "entity_id")


def usable_update() -> Column:
    """Whether a raw prediction is staged at all."""
    is_kind = F.upper(trimmed("event_type")).isin(*EVENT_TYPES)
    return F.col("event_time").isNotNull() & has_text("route_id") & is_kind


def keyed_updates(raw: DataFrame, extra_key: Sequence[str] = ()) -> DataFrame:
    """Cleaned predictions with their key, usable or not."""
    cleaned = raw.select(
        "ingested_at",
        "feed_timestamp",
        "source",
        "entity_id",
        *(clean_text(c).alias(c) for c in ("trip_id", "route_id", "start_date", "start_time", "stop_id")),
        "stop_sequence",
        F.upper(trimmed("event_type")).alias("event_type"),
        "event_time",
        "delay_sec",
        "schedule_relationship",
    )
    return cleaned.withColumn("event_key", stop_event_key(extra=extra_key))


def clean_trip_updates(raw: DataFrame, extra_key: Sequence[str] = ()) -> DataFrame:
    """Usable stop predictions with their key, before the newest per key is chosen."""
    return keyed_updates(raw.where(usable_update()), extra_key)


def stg_trip_updates(raw: DataFrame, extra_key: Sequence[str] = ()) -> DataFrame:
    """Newest prediction per stop event."""
    return latest_per_key(clean_trip_updates(raw, extra_key), ["event_key"], [F.desc(c) for c in NEWEST_UPDATE])


def clean_vehicle_positions(raw: DataFrame) -> DataFrame:
    """Usable pings with their key, before the last copy of each is chosen.

    The null test looks at the vehicle id as delivered: a blank id passes it, turns null in
    cleaning, and all such rows share the null key.
    """
    cleaned = raw.where(F.col("timestamp").isNotNull() & F.col("vehicle_id").isNotNull()).select(
        "ingested_at",
        "feed_timestamp",
        "source",
        "entity_id",
        *(clean_text(c).alias(c) for c in ("vehicle_id", "trip_id", "route_id")),
        "position_lat",
        "position_lon",
        "bearing",
        "speed",
        "current_status",
        "current_stop_sequence",
        clean_text("stop_id").alias("stop_id"),
        "timestamp",
    )
    return cleaned.withColumn("vehicle_event_key", vehicle_ping_key())


def stg_vehicle_positions(raw: DataFrame) -> DataFrame:
    """Last ingested copy of every ping; of the rows that share the null key one stays."""
    return latest_per_key(clean_vehicle_positions(raw), ["vehicle_event_key"], [F.desc(c) for c in NEWEST_PING])
