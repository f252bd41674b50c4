"""Route and date dimensions, from the golden events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dim_route(events: DataFrame) -> DataFrame:
    return events.where(F.col("route_id").isNotNull()).select("route_id").distinct()


def dim_date(events: DataFrame) -> DataFrame:
    """Observed days. The week starts on Sunday (1)."""
    day = F.col("date_day")
    return (
        events.select(F.col("event_date").alias("date_day"))
        .distinct()
        .select(
            day,
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"),
            F.dayofweek(day).alias("day_of_week"),
            F.date_format(day, "EEEE").alias("day_name"),
        )
    )
