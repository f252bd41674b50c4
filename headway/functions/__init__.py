"""Column expressions shared by the models."""

from headway.functions.clock import (
    EPOCH,
    epoch_to_utc,
    from_instant,
    hour_start,
    to_instant,
    utc_literal,
    utc_now,
    whole_hours_between,
    whole_minutes_between,
)
from headway.functions.keys import stop_event_key, vehicle_ping_key
from headway.functions.text import clean_text, has_text, trimmed, zero_to_null

__all__ = [
    "EPOCH",
    "clean_text",
    "epoch_to_utc",
    "from_instant",
    "has_text",
    "hour_start",
    "stop_event_key",
    "to_instant",
    "trimmed",
    "utc_literal",
    "utc_now",
    "vehicle_ping_key",
    "whole_hours_between",
    "whole_minutes_between",
    "zero_to_null",
]
