"""One ingest run over both feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame

from headway.functions import utc_literal
from headway.sources.feeds import flatten_trip_updates, flatten_vehicle_positions
from headway.sources.raw_log import append_raw


def run_ingest(
    trip_feed: DataFrame, vehicle_feed: DataFrame, trip_log: str, vehicle_log: str, ingested_at=None
) -> dict[str, int]:
    """Flattens and appends both feeds; the rows of one feed share one ingestion time.

    The two appends are separate jobs, so a broken vehicle feed does not undo the trip rows.
    """
    stamp = None if ingested_at is None else utc_literal(ingested_at)
    return {
        "trip_rows": append_raw(flatten_trip_updates(trip_feed, stamp), trip_log),
        "vehicle_rows": append_raw(flatten_vehicle_positions(vehicle_feed, stamp), vehicle_log),
    }
