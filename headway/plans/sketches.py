"""Percentiles of days and weeks from stored sketches of hours.

Percentiles of hours cannot be averaged into those of days. A KLL sketch per route and hour
can be merged: it holds all values while there are at most ``K`` of them, and then a sample
whose ranks are off by at most ``RANK_ERROR`` of the events (at 99 % confidence, whatever the
size of the group). A sketch is a few tens of kilobytes at most, so a day of a route is merged
from 24 of them and no event is read again. Map tasks make sketches of their own rows before
the shuffle, so a hot route costs one sketch per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 4096
# Of the published error of this sketch for single ranks: 2.296 / k ** 0.9723.
RANK_ERROR = 2.296 / K**0.9723
SKETCHES = "route_id string, event_hour timestamp_ntz, delays binary"


def hourly_sketches(events: DataFrame) -> DataFrame:
    """A sketch of the delays per route and hour; events without a route or delay are left out."""
    usable = events.where(F.col("route_id").isNotNull() & F.col("delay_sec").isNotNull())
    sketch = F.kll_sketch_agg_bigint(F.col("delay_sec").cast("bigint"), F.lit(K))
    return usable.groupBy("route_id", "event_hour").agg(sketch.alias("delays"))


def _first_day(period: str) -> Column:
    day = F.to_date("event_hour")
    if period == "day":
        return day
    if period == "week":  # from Monday
        return F.date_sub(day, F.weekday(day))
    raise ValueError(f"no such period: {period}")


def delay_percentiles(sketches: DataFrame, period: str = "day") -> DataFrame:
    """Events, median and 90th percentile per route and day or week, as the smallest delay that
    covers that share of the events."""
    merged = sketches.groupBy("route_id", _first_day(period).alias("first_day")).agg(
        F.kll_merge_agg_bigint("delays").alias("delays")
    )
    both = F.kll_sketch_get_quantile_bigint("delays", F.array(F.lit(0.5), F.lit(0.9)))
    return merged.select(
        "route_id",
        F.lit(period).alias("period"),
        "first_day",
        F.kll_sketch_get_n_bigint("delays").alias("num_events"),
        both[0].cast("int").alias("p50_delay_sec"),
        both[1].cast("int").alias("p90_delay_sec"),
    )
