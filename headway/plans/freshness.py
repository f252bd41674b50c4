"""Age of the newest data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions import whole_hours_between, whole_minutes_between
from headway.functions.clock import as_of_column

AsOf = Column | dt.datetime | str | None

# Fixed values, in minutes: the dashboard turns red above the first, a source is late above the second.
STALE_AFTER_MIN = 120
SOURCE_WARN_AFTER_MIN = 60


def mart_data_freshness(staged: DataFrame, as_of: AsOf = None) -> DataFrame:
    newest = F.col("last_feed_timestamp")
    now = F.col("checked_at")
    return (
        staged.agg(F.max("feed_timestamp").alias("last_feed_timestamp"))
        .select(as_of_column(as_of).alias("checked_at"), newest)
        .select(now, newest, whole_hours_between(newest, now).alias("hours_since_last_feed"))
    )


def freshness_alert(freshness: DataFrame) -> DataFrame:
    """Whole hours hide up to 59 minutes, so the alarm looks at minutes."""
    minutes = whole_minutes_between(F.col("last_feed_timestamp"), F.col("checked_at"))
    return freshness.select(
        "checked_at",
        "last_feed_timestamp",
        "hours_since_last_feed",
        minutes.alias("minutes_since_last_feed"),
        F.coalesce(minutes > STALE_AFTER_MIN, F.lit(True)).alias("is_stale"),
    )


def source_freshness(raw_tables: dict[str, DataFrame], as_of: AsOf = None) -> DataFrame:
    """One row per raw log: newest ingestion, its age, and pass or warn."""
    parts = [
        raw.agg(F.max("ingested_at").alias("max_loaded_at")).select(F.lit(name).alias("source_table"), "max_loaded_at")
        for name, raw in raw_tables.items()
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    age = whole_minutes_between(F.col("max_loaded_at"), as_of_column(as_of))
    late = F.coalesce(F.col("max_loaded_at") < as_of_column(as_of) - F.expr(f"interval {SOURCE_WARN_AFTER_MIN} minutes"), F.lit(True))
    return rows.select(
        "source_table",
        "max_loaded_at",
        age.alias("age_minutes"),
        F.when(late, "warn").otherwise("pass").alias("status"),
    )
