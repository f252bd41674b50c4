"""Delay and reliability metrics per route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: an event counts as delayed from five minutes on.
DELAYED_FROM_SEC = 300
# Counts of events per route, hour and delay, and the columns that place an event in them.
DELAY_OF = ("route_id", "event_hour", "delay_sec")
DELAY_COUNTS = "route_id string, event_hour timestamp_ntz, delay_sec int, n bigint, date_day date"


def share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole)


def weighted_mean(value: str, weight: str) -> Column:
    return F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight))


def _usable(events: DataFrame) -> DataFrame:
    return events.where(F.col("route_id").isNotNull() & F.col("delay_sec").isNotNull())


def delay_counts(events: DataFrame) -> DataFrame:
    """Events per route, hour and delay. Counts of parts of the events add up."""
    return _usable(events).groupBy("route_id", "event_hour", "delay_sec").agg(F.count("*").alias("n"))


def with_day(counts: DataFrame) -> DataFrame:
    return counts.withColumn("date_day", F.to_date("event_hour"))


def signed_counts(accepted: DataFrame) -> DataFrame:
    """What accepted events change in the counts: +1 where each is, -1 where the event it
    replaces was. What cancels out is left out."""
    now = F.struct(*DELAY_OF, F.lit(1).cast("bigint").alias("n"))
    before = F.when(
        F.col("replaced").isNotNull(), F.struct(*(F.col(f"replaced.{c}") for c in DELAY_OF), F.lit(-1).cast("bigint").alias("n"))
    )
    return summed_counts(with_day(accepted.select(F.inline(F.array_compact(F.array(now, before))))))


def summed_counts(counts: DataFrame) -> DataFrame:
    """Counts and signed counts of the same route, hour and delay added up; none of zero is left."""
    total = _usable(counts).groupBy("route_id", "event_hour", "delay_sec", "date_day").agg(F.sum("n").alias("n"))
    return total.where(F.col("n") != 0).select(*(f.split()[0] for f in DELAY_COUNTS.split(", ")))


def int_route_delay_hourly(events: DataFrame) -> DataFrame:
    """Counts, mean and exact percentiles per route and hour.

    Events are first counted per route, hour and delay, which map tasks do before the
    shuffle. Golden delays are whole seconds within fixed bounds, so a group has at most
    16,201 such counts however hot the route; mean and percentiles come from them.
    """
    return hourly_of_counts(delay_counts(events))


def hourly_of_counts(counts: DataFrame) -> DataFrame:
    """Hourly metrics from (route_id, event_hour, delay_sec, n), one row for each."""
    group = Window.partitionBy("route_id", "event_hour")
    ranked = counts.withColumns(
        {"up_to": F.sum("n").over(group.orderBy("delay_sec")), "total": F.sum("n").over(group)}
    )

    def percentile(percent: int) -> Column:
        reached = F.col("up_to") * 100 >= F.col("total") * percent
        return F.min(F.when(reached, F.col("delay_sec")))

    events_in_group = F.sum("n")
    delayed = F.coalesce(F.sum(F.when(F.col("delay_sec") >= DELAYED_FROM_SEC, F.col("n"))), F.lit(0).cast("bigint"))
    return ranked.groupBy("route_id", "event_hour").agg(
        events_in_group.alias("num_events"),
        share(F.sum(F.col("delay_sec") * F.col("n")), events_in_group).alias("avg_delay_sec"),
        percentile(50).alias("p50_delay_sec"),
        percentile(90).alias("p90_delay_sec"),
        delayed.alias("delayed_5m_events"),
        share(delayed, events_in_group).alias("pct_events_delayed_5m"),
    )


def hourly_totals(events: DataFrame) -> DataFrame:
    """What days are made of, in one shuffle: the hourly metrics without percentiles."""
    delayed = F.count_if(F.col("delay_sec") >= DELAYED_FROM_SEC)
    return _usable(events).groupBy("route_id", "event_hour").agg(
        F.count("*").alias("num_events"),
        share(F.sum("delay_sec"), F.count("*")).alias("avg_delay_sec"),
        delayed.alias("delayed_5m_events"),
    )


def route_delay_hourly_sketch(events: DataFrame, accuracy: int = 10000) -> DataFrame:
    """As the exact form in one shuffle, with percentiles off by at most 1/accuracy of the ranks.

    Also valid on a stream of events that are never revised.
    """
    both = F.percentile_approx("delay_sec", [0.5, 0.9], accuracy)
    delayed = F.count_if(F.col("delay_sec") >= DELAYED_FROM_SEC)
    return _usable(events).groupBy("route_id", "event_hour").agg(
        F.count("*").alias("num_events"),
        F.avg("delay_sec").alias("avg_delay_sec"),
        both[0].alias("p50_delay_sec"),
        both[1].alias("p90_delay_sec"),
        delayed.alias("delayed_5m_events"),
        share(delayed, F.count("*")).alias("pct_events_delayed_5m"),
    )


def fct_route_delay_hourly(hourly: DataFrame) -> DataFrame:
    return hourly.select(
        "route_id",
        "event_hour",
        F.to_date("event_hour").alias("date_day"),
        "num_events",
        "avg_delay_sec",
        "p50_delay_sec",
        "p90_delay_sec",
        "delayed_5m_events",
        "pct_events_delayed_5m",
    )


def fct_route_delay_daily(hourly: DataFrame) -> DataFrame:
    """Rolls hours up to days; counts add, the mean is weighted by events."""
    usable = hourly.where(F.col("route_id").isNotNull() & F.col("event_hour").isNotNull())
    return usable.groupBy("route_id", F.to_date("event_hour").alias("date_day")).agg(
        F.sum("num_events").alias("total_events"),
        weighted_mean("avg_delay_sec", "num_events").alias("avg_delay_sec"),
        F.sum("delayed_5m_events").alias("delayed_5m_events"),
        share(F.sum("delayed_5m_events"), F.sum("num_events")).alias("pct_events_delayed_5m"),
    )


# Metric, the stem its comparison columns use, and the name of its difference columns.
_COMPARED = (
    ("pct_events_delayed_5m", "pct_delayed", "pct_delayed"),
    ("avg_delay_sec", "avg_delay", "avg_delay_sec"),
)


def _with_differences(df: DataFrame) -> DataFrame:
    changes = {
        f"{prefix}_{changed}": F.col(metric) - F.col(f"{stem}_prev_{period}")
        for metric, stem, changed in _COMPARED
        for prefix, period in (("dod", "day"), ("wow", "week"))
    }
    return df.withColumns(changes)


def fct_route_delay_daily_compare(daily: DataFrame) -> DataFrame:
    """Change against the previous and the seventh previous row of the route.

    Rows, not days: with service gaps the seventh row back is further than a week. A route
    has one row per day here, so its window is small whatever its share of events.
    """
    by_day = Window.partitionBy("route_id").orderBy("date_day")
    earlier = {
        f"{stem}_prev_{period}": F.lag(metric, rows).over(by_day)
        for metric, stem, _ in _COMPARED
        for period, rows in (("day", 1), ("week", 7))
    }
    return _with_differences(daily.withColumns(earlier))


def fct_route_delay_daily_compare_calendar(daily: DataFrame) -> DataFrame:
    """As the row form, against the calendar day before and the same weekday a week before."""
    by_calendar = Window.partitionBy("route_id").orderBy(F.unix_date("date_day"))

    def on_day(metric: str, days: int) -> Column:
        frame = by_calendar.rangeBetween(-days, -days)
        return F.max(metric).over(frame)

    earlier = {
        f"{stem}_prev_{period}": on_day(metric, days)
        for metric, stem, _ in _COMPARED
        for period, days in (("day", 1), ("week", 7))
    }
    return _with_differences(daily.withColumns(earlier))


def fct_route_delay_daily_rolling(daily: DataFrame) -> DataFrame:
    """Plain mean over a route's last seven rows, fewer at its start."""
    last_seven = Window.partitionBy("route_id").orderBy("date_day").rowsBetween(-6, 0)
    return daily.select(
        "route_id",
        "date_day",
        F.avg("pct_events_delayed_5m").over(last_seven).alias("pct_delayed_7d_avg"),
        F.avg("avg_delay_sec").over(last_seven).alias("avg_delay_7d_avg"),
    )
