"""Golden stop events: staged predictions with believable delays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions import hour_start

# Seconds, 30 minutes early to 4 hours late, both ends kept.
EARLIEST_DELAY_SEC = -1800
LATEST_DELAY_SEC = 14400


def int_trip_stop_events_deduped(staged: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Full-rebuild form; ``headway.operators.upsert`` applies it to increments, which also
    ``keep`` the columns that settle ties."""
    return staged.where(F.col("delay_sec").between(EARLIEST_DELAY_SEC, LATEST_DELAY_SEC)).select(
        "event_key",
        "route_id",
        "trip_id",
        "stop_id",
        "stop_sequence",
        "event_type",
        "event_time",
        "delay_sec",
        "ingested_at",
        "feed_timestamp",
        F.to_date("event_time").alias("event_date"),
        hour_start(F.col("event_time")).alias("event_hour"),
        *keep,
    )
