"""Declared schemas as DDL text: raw logs, nested feeds and model outputs.

Timestamps are ``TIMESTAMP_NTZ`` holding UTC, so no result depends on the session zone.
"""

from __future__ import annotations

from pyspark.sql import types as T


def struct(ddl: str) -> T.StructType:
    """Needs a running session."""
    return T.StructType.fromDDL(ddl)


RAW_TRIP_UPDATES = (
    "ingested_at timestamp_ntz, feed_timestamp timestamp_ntz, source string, entity_id string, "
    "trip_id string, route_id string, start_date string, start_time string, stop_id string, "
    "stop_sequence int, event_type string, event_time timestamp_ntz, delay_sec int, "
    "schedule_relationship string, raw_json string"
)

RAW_VEHICLE_POSITIONS = (
    "ingested_at timestamp_ntz, feed_timestamp timestamp_ntz, source string, entity_id string, "
    "vehicle_id string, trip_id string, route_id string, position_lat double, position_lon double, "
    "bearing double, speed double, current_status string, current_stop_sequence int, "
    "stop_id string, timestamp timestamp_ntz, raw_json string"
)

TRIP_FEED = (
    "header struct<timestamp:bigint>, "
    "entity array<struct<id:string, trip_update:struct<"
    "trip:struct<trip_id:string,route_id:string,start_date:string,start_time:string,schedule_relationship:int>,"
    "stop_time_update:array<struct<stop_id:string,stop_sequence:int,"
    "arrival:struct<time:bigint,delay:int>,departure:struct<time:bigint,delay:int>>>>>>"
)

VEHICLE_FEED = (
    "header struct<timestamp:bigint>, "
    "entity array<struct<id:string, vehicle:struct<"
    "vehicle:struct<id:string>,trip:struct<trip_id:string,route_id:string>,"
    "position:struct<latitude:double,longitude:double,bearing:double,speed:double>,"
    "current_status:int,current_stop_sequence:int,stop_id:string,timestamp:bigint>>>"
)

MODELS = {
    "stg_trip_updates": (
        "ingested_at timestamp_ntz, feed_timestamp timestamp_ntz, source string, entity_id string, "
        "trip_id string, route_id string, start_date string, start_time string, stop_id string, "
        "stop_sequence int, event_type string, event_time timestamp_ntz, delay_sec int, "
        "schedule_relationship string, event_key string"
    ),
    "stg_vehicle_positions": (
        "ingested_at timestamp_ntz, feed_timestamp timestamp_ntz, source string, entity_id string, "
        "vehicle_id string, trip_id string, route_id string, position_lat double, position_lon double, "
        "bearing double, speed double, current_status string, current_stop_sequence int, "
        "stop_id string, timestamp timestamp_ntz, vehicle_event_key string"
    ),
    "int_trip_stop_events_deduped": (
        "event_key string, route_id string, trip_id string, stop_id string, stop_sequence int, "
        "event_type string, event_time timestamp_ntz, delay_sec int, ingested_at timestamp_ntz, "
        "feed_timestamp timestamp_ntz, event_date date, event_hour timestamp_ntz"
    ),
    "int_route_delay_hourly": (
        "route_id string, event_hour timestamp_ntz, num_events bigint, avg_delay_sec double, "
        "p50_delay_sec int, p90_delay_sec int, delayed_5m_events bigint, pct_events_delayed_5m double"
    ),
    "fct_route_delay_hourly": (
        "route_id string, event_hour timestamp_ntz, date_day date, num_events bigint, "
        "avg_delay_sec double, p50_delay_sec int, p90_delay_sec int, delayed_5m_events bigint, "
        "pct_events_delayed_5m double"
    ),
    "fct_route_delay_daily": (
        "route_id string, date_day date, total_events bigint, avg_delay_sec double, "
        "delayed_5m_events bigint, pct_events_delayed_5m double"
    ),
    "fct_route_delay_daily_compare": (
        "route_id string, date_day date, total_events bigint, avg_delay_sec double, "
        "delayed_5m_events bigint, pct_events_delayed_5m double, "
        "pct_delayed_prev_day double, pct_delayed_prev_week double, "
        "avg_delay_prev_day double, avg_delay_prev_week double, "
        "dod_pct_delayed double, wow_pct_delayed double, "
        "dod_avg_delay_sec double, wow_avg_delay_sec double"
    ),
    "fct_route_delay_daily_rolling": (
        "route_id string, date_day date, pct_delayed_7d_avg double, avg_delay_7d_avg double"
    ),
    "fct_latest_vehicle_positions": (
        "vehicle_id string, trip_id string, route_id string, position_lat double, position_lon double, "
        "bearing double, speed double, last_updated_at timestamp_ntz, minutes_since_update bigint, "
        "current_delay_sec int"
    ),
    "dim_route": "route_id string",
    "dim_date": (
        "date_day date, year int, month int, day int, day_of_week int, day_name string"
    ),
    "mart_data_freshness": (
        "checked_at timestamp_ntz, last_feed_timestamp timestamp_ntz, hours_since_last_feed bigint"
    ),
}
