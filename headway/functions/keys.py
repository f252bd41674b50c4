"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def stop_event_key(
    trip_id: str = "trip_id",
    stop_id: str = "stop_id",
    event_type: str = "event_type",
    extra: Sequence[str] = (),
) -> Column:
    """Hash of trip, stop and event type; a missing part counts as empty text.

    ``extra`` adds columns (such as ``start_date``) for users who want one key per service
    day. Without it a later day's event of the same trip replaces the earlier day's.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (trip_id, stop_id, event_type, *extra)]
    return F.md5(F.concat_ws("-", *parts))


def vehicle_ping_key(vehicle_id: str = "vehicle_id", timestamp: str = "timestamp") -> Column:
    """Hash of vehicle and ping time; null when the vehicle id is null."""
    return F.md5(F.concat(F.col(vehicle_id), F.lit("-"), F.col(timestamp).cast("string")))
