"""Raw logs and nested feeds derived from a generic ``events`` table.

Stands in for the live feeds: each event becomes one prediction and one ping of a poll that
runs every 20 minutes. Plain projections, so they scale with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions import EPOCH, utc_literal

POLL_MINUTES = 20


EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _poll_start() -> Column:
    ts = F.col("ts")
    minutes = F.hour(ts) * 60 + F.minute(ts) - F.minute(ts) % POLL_MINUTES
    return F.timestamp_add("MINUTE", minutes, F.to_date(ts).cast("timestamp_ntz"))


def _text(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def _null_when(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _common(source: str) -> list[Column]:
    poll = _poll_start()
    return [
        F.timestamp_add("MINUTE", F.lit(POLL_MINUTES), poll).alias("ingested_at"),
        poll.alias("feed_timestamp"),
        F.lit(source).alias("source"),
        F.col("event_id").cast("string").alias("entity_id"),
    ]


def raw_trip_updates(events: DataFrame) -> DataFrame:
    user, event, ts = F.col("user_id"), F.col("event_id"), F.col("ts")
    out_of_service = (user % 12 == 3) & F.dayofmonth(ts).isin(10, 11)
    delay = F.nullif(F.floor(F.col("value") * 60) - 1900, F.lit(0).cast("bigint")).cast("int")
    return events.select(
        *_common("synthetic_trip_updates"),
        F.when(_every(97), "  ").otherwise(_text("T", user)).alias("trip_id"),
        F.when(_every(53) | out_of_service, "")
        .otherwise(F.concat(_text(" R", user % 12), F.lit(" ")))
        .alias("route_id"),
        F.date_format(F.to_date(ts), "yyyyMMdd").alias("start_date"),
        F.concat(F.substring(ts.cast("string"), 12, 5), F.lit(":00")).alias("start_time"),
        _null_when(_every(89), _text("S", event % 40)).alias("stop_id"),
        F.nullif(event % 40, F.lit(0).cast("bigint")).cast("int").alias("stop_sequence"),
        F.when(_every(20), "SKIPPED")
        .when(_every(2), " arrival")
        .otherwise("Departure ")
        .alias("event_type"),
        _null_when(_every(101), ts).alias("event_time"),
        _null_when(_every(29), delay).alias("delay_sec"),
        F.lit("0").alias("schedule_relationship"),
        F.lit(None).cast("string").alias("raw_json"),
    )


def raw_vehicle_positions(events: DataFrame) -> DataFrame:
    user, event, ts = F.col("user_id"), F.col("event_id"), F.col("ts")
    return events.select(
        *_common("synthetic_vehicle_positions"),
        F.when(_every(61), "").otherwise(_text("V", user)).alias("vehicle_id"),
        F.when(_every(3), _text("X", user)).when(_every(97), "  ").otherwise(_text("T", user)).alias("trip_id"),
        _text("R", user % 12).alias("route_id"),
        _null_when(_every(43), F.lit(37.0) + event % 1000 / 1000).alias("position_lat"),
        (F.lit(-122.0) - event % 700 / 1000).alias("position_lon"),
        (event % 360).cast("double").alias("bearing"),
        F.col("value").cast("double").alias("speed"),
        F.lit("2").alias("current_status"),
        F.nullif(event % 40, F.lit(0).cast("bigint")).cast("int").alias("current_stop_sequence"),
        _text("S", event % 40).alias("stop_id"),
        _null_when(_every(101), F.to_date(ts).cast("timestamp_ntz")).alias("timestamp"),
        F.lit(None).cast("string").alias("raw_json"),
    )


def _epoch_seconds(moment: Column) -> Column:
    seconds = (moment - utc_literal(EPOCH)).cast("interval second")
    return F.coalesce(F.floor(seconds.cast("decimal(18,6)")).cast("bigint"), F.lit(0).cast("bigint"))


def trip_feed(events: DataFrame) -> DataFrame:
    """Nested trip messages, one per event, plus the ingestion time of its poll.

    Each message holds the prediction, a stop update without times and an entity of another
    kind, so flattening has something to drop.
    """
    raw = raw_trip_updates(events)
    kind = F.upper(F.trim("event_type"))
    at = F.struct(_epoch_seconds(F.col("event_time")).alias("time"), F.coalesce("delay_sec", F.lit(0)).alias("delay"))
    unset = F.struct(F.lit(0).cast("bigint").alias("time"), F.lit(0).alias("delay"))

    def stop_update(arrival: Column, departure: Column) -> Column:
        return F.struct(
            F.coalesce("stop_id", F.lit("")).alias("stop_id"),
            F.coalesce("stop_sequence", F.lit(0)).alias("stop_sequence"),
            arrival.alias("arrival"),
            departure.alias("departure"),
        )

    trip = F.struct(
        "trip_id", "route_id", "start_date", "start_time", F.col("schedule_relationship").cast("int").alias("schedule_relationship")
    )
    updates = F.array(
        stop_update(F.when(kind == "ARRIVAL", at).otherwise(unset), F.when(kind == "DEPARTURE", at).otherwise(unset)),
        stop_update(unset, unset),
    )
    update = F.struct(trip.alias("trip"), updates.alias("stop_time_update"))
    entity = F.array(
        F.struct(F.col("entity_id").alias("id"), update.alias("trip_update")),
        F.struct(F.lit("alert").alias("id"), F.when(F.lit(False), update).alias("trip_update")),
    )
    return raw.select(
        "ingested_at",
        F.struct(_epoch_seconds(F.col("feed_timestamp")).alias("timestamp")).alias("header"),
        entity.alias("entity"),
    )


def vehicle_feed(events: DataFrame) -> DataFrame:
    """Nested vehicle messages, one per event, plus the ingestion time of its poll."""
    raw = raw_vehicle_positions(events)
    vehicle = F.struct(
        F.struct(F.col("vehicle_id").alias("id")).alias("vehicle"),
        F.struct("trip_id", "route_id").alias("trip"),
        F.struct(
            F.col("position_lat").alias("latitude"), F.col("position_lon").alias("longitude"), "bearing", "speed"
        ).alias("position"),
        F.col("current_status").cast("int").alias("current_status"),
        F.coalesce("current_stop_sequence", F.lit(0)).alias("current_stop_sequence"),
        "stop_id",
        _epoch_seconds(F.col("timestamp")).alias("timestamp"),
    )
    return raw.select(
        "ingested_at",
        F.struct(_epoch_seconds(F.col("feed_timestamp")).alias("timestamp")).alias("header"),
        F.array(F.struct(F.col("entity_id").alias("id"), vehicle.alias("vehicle"))).alias("entity"),
    )


# Riders of a poll are dealt to this many messages, as large feeds come in pages.
_PAGES = 4


def _page() -> Column:
    return F.pmod("user_id", F.lit(_PAGES))


def trip_polls(events: DataFrame) -> DataFrame:
    """Whole polls as messages: an entity per trip, a stop update per event with an arrival, a
    departure 40 seconds after it, both or neither, and an entity of another kind."""
    event, user = F.col("event_id"), F.col("user_id")
    wanted = "feed_timestamp", "event_time", "delay_sec", "stop_id", "stop_sequence"
    rows = raw_trip_updates(events).select(F.col("entity_id").cast("bigint").alias("event_id"), *wanted)
    at = _epoch_seconds(F.col("event_time"))
    delay = F.coalesce("delay_sec", F.lit(0))
    zero = F.lit(0).cast("bigint")
    arrival = F.struct(F.when(event % 3 != 1, at).otherwise(zero).alias("time"), delay.alias("delay"))
    leaves = (event % 3 != 0) & (at != 0)
    departure = F.struct(F.when(leaves, at + 40).otherwise(zero).alias("time"), (delay + 10).cast("int").alias("delay"))
    stop = F.struct(
        F.coalesce("stop_id", F.lit("")).alias("stop_id"),
        F.coalesce("stop_sequence", F.lit(0)).alias("stop_sequence"),
        arrival.alias("arrival"),
        departure.alias("departure"),
    )
    riders = events.select("event_id", "user_id")
    trips = rows.join(riders, "event_id").groupBy("feed_timestamp", "user_id").agg(F.collect_list(stop).alias("stops"))
    trip = F.struct(
        _text("T", user).alias("trip_id"),
        _text("R", user % 12).alias("route_id"),
        F.date_format("feed_timestamp", "yyyyMMdd").alias("start_date"),
        F.lit("08:00:00").alias("start_time"),
        (user % 4).cast("int").alias("schedule_relationship"),
    )
    update = F.struct(trip.alias("trip"), F.col("stops").alias("stop_time_update"))
    entity = F.struct(_text("E", user).alias("id"), update.alias("trip_update"))
    alert = F.struct(F.lit("alert").alias("id"), F.when(F.lit(False), update).alias("trip_update"))
    messages = trips.groupBy("feed_timestamp", _page().alias("page")).agg(
        F.collect_list(entity).alias("entity"), F.first(alert).alias("alert")
    )
    return messages.select(
        F.struct(_epoch_seconds(F.col("feed_timestamp")).alias("timestamp")).alias("header"),
        F.array_append("entity", F.col("alert")).alias("entity"),
    )


def vehicle_polls(events: DataFrame) -> DataFrame:
    """Whole polls as messages with an entity per ping."""
    single = vehicle_feed(events).select("header", F.explode("entity").alias("entity"))
    page = F.pmod(F.xxhash64("entity.vehicle.vehicle.id"), F.lit(_PAGES))
    return single.groupBy("header", page.alias("page")).agg(F.collect_list("entity").alias("entity")).drop("page")
