"""Figures the dashboard shows on top of the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.plans.delays import weighted_mean

# Fixed value, in minutes: vehicles silent for longer are ghosts.
GHOST_AFTER_MIN = 20


def network_avg_delay(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.sum("total_events").alias("total_events"),
        weighted_mean("avg_delay_sec", "total_events").alias("avg_delay_sec"),
    )


def daily_delay_trend(daily: DataFrame) -> DataFrame:
    return daily.groupBy("date_day").agg(
        F.sum("total_events").alias("total_events"),
        weighted_mean("avg_delay_sec", "total_events").alias("avg_delay_sec"),
    )


def daily_delay_trend_compare(daily: DataFrame) -> DataFrame:
    """The network's trend beside that of seven calendar days earlier; null where that day has none.

    One row per day is joined, never the events.
    """
    trend = daily_delay_trend(daily)
    earlier = trend.select(
        F.date_add("date_day", 7).alias("later_day"), F.col("avg_delay_sec").alias("avg_delay_prev_week")
    )
    return trend.join(earlier, F.col("date_day") == F.col("later_day"), "left").select(
        *trend.columns,
        "avg_delay_prev_week",
        (F.col("avg_delay_sec") - F.col("avg_delay_prev_week")).alias("wow_avg_delay_sec"),
    )


def hourly_intensity_pivot(hourly: DataFrame) -> DataFrame:
    """Mean delay per route and hour of day, one column per hour."""
    cells = (
        hourly.withColumn("hour_of_day", F.hour("event_hour"))
        .groupBy("route_id")
        .pivot("hour_of_day", list(range(24)))
        .agg(weighted_mean("avg_delay_sec", "num_events"))
    )
    return cells.select("route_id", *(F.col(str(h)).alias(f"h{h:02d}") for h in range(24)))


def delay_heatmap_grid(live: DataFrame, cells_per_degree: int = 100) -> DataFrame:
    """Vehicles and their delay per map cell."""

    def cell(name: str):
        return F.floor(F.col(name) * cells_per_degree).cast("bigint")

    return live.groupBy(cell("position_lat").alias("lat_cell"), cell("position_lon").alias("lon_cell")).agg(
        F.count("*").alias("vehicles"),
        F.sum("current_delay_sec").alias("total_delay_sec"),
        F.avg("current_delay_sec").alias("avg_delay_sec"),
    )


def active_vehicles(live: DataFrame, ghost_after_min: int = GHOST_AFTER_MIN) -> DataFrame:
    return live.where(F.col("minutes_since_update") <= ghost_after_min)


def worst_delays_topk(live: DataFrame, k: int = 10) -> DataFrame:
    named = live.where(F.col("vehicle_id").isNotNull())
    return named.orderBy(F.desc("current_delay_sec"), F.asc("vehicle_id")).limit(k)


def routes_getting_slower(compare: DataFrame) -> DataFrame:
    """Route-days slower than the seventh row before."""
    return compare.where(F.col("wow_avg_delay_sec") > 0).select(
        "route_id", "date_day", "avg_delay_sec", "avg_delay_prev_week", "wow_avg_delay_sec"
    )
