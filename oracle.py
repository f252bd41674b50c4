"""DuckDB SQL that states the expected result of every registered query.

Written apart from the Spark models, over the same ``events`` table: ``DISTINCT ON`` instead
of ranked windows, ``quantile_disc`` for percentiles, self joins for the calendar comparison.
"""

from __future__ import annotations

from headway.schemas import MODELS

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
AFTER_MIDNIGHT = "TIMESTAMP '2024-01-30 00:15:00'"
CUTOFF = "TIMESTAMP '2024-01-15 00:00:00'"
SLICES = ("TIMESTAMP '2024-01-11 00:00:00'", "TIMESTAMP '2024-01-21 00:00:00'")

_POLLED = """
polled AS (
  SELECT *, date_trunc('hour', ts) + CAST(floor(minute(ts) / 20) AS INTEGER) * INTERVAL '20' MINUTE AS slot
  FROM events
)"""

_RAW_TRIP = _POLLED + """,
raw_trip AS (
  SELECT slot + INTERVAL '20' MINUTE AS ingested_at,
    slot AS feed_timestamp,
    'synthetic_trip_updates' AS source,
    CAST(event_id AS VARCHAR) AS entity_id,
    CASE WHEN event_id % 97 = 0 THEN '  ' ELSE 'T' || user_id END AS trip_id,
    CASE WHEN event_id % 53 = 0 OR (user_id % 12 = 3 AND day(ts) IN (10, 11)) THEN ''
         ELSE ' R' || (user_id % 12) || ' ' END AS route_id,
    strftime(ts, '%Y%m%d') AS start_date,
    strftime(ts, '%H:%M:00') AS start_time,
    CASE WHEN event_id % 89 <> 0 THEN 'S' || (event_id % 40) END AS stop_id,
    CAST(nullif(event_id % 40, 0) AS INTEGER) AS stop_sequence,
    CASE WHEN event_id % 20 = 0 THEN 'SKIPPED' WHEN event_id % 2 = 0 THEN ' arrival' ELSE 'Departure ' END AS event_type,
    CASE WHEN event_id % 101 <> 0 THEN ts END AS event_time,
    CASE WHEN event_id % 29 <> 0 THEN CAST(nullif(floor(value * 60) - 1900, 0) AS INTEGER) END AS delay_sec,
    '0' AS schedule_relationship,
    CAST(NULL AS VARCHAR) AS raw_json
  FROM polled
)"""

_RAW_VEHICLE_BODY = """
raw_vehicle AS (
  SELECT slot + INTERVAL '20' MINUTE AS ingested_at,
    slot AS feed_timestamp,
    'synthetic_vehicle_positions' AS source,
    CAST(event_id AS VARCHAR) AS entity_id,
    CASE WHEN event_id % 61 = 0 THEN '' ELSE 'V' || user_id END AS vehicle_id,
    CASE WHEN event_id % 3 = 0 THEN 'X' || user_id WHEN event_id % 97 = 0 THEN '  ' ELSE 'T' || user_id END AS trip_id,
    'R' || (user_id % 12) AS route_id,
    CASE WHEN event_id % 43 <> 0 THEN 37.0::DOUBLE + (event_id % 1000)::DOUBLE / 1000 END AS position_lat,
    -122.0::DOUBLE - (event_id % 700)::DOUBLE / 1000 AS position_lon,
    CAST(event_id % 360 AS DOUBLE) AS bearing,
    CAST(value AS DOUBLE) AS speed,
    '2' AS current_status,
    CAST(nullif(event_id % 40, 0) AS INTEGER) AS current_stop_sequence,
    'S' || (event_id % 40) AS stop_id,
    CASE WHEN event_id % 101 <> 0 THEN date_trunc('day', ts)::TIMESTAMP END AS timestamp,
    CAST(NULL AS VARCHAR) AS raw_json
  FROM polled
)"""
_RAW_VEHICLE = _POLLED + "," + _RAW_VEHICLE_BODY
_RAW_BOTH = _RAW_TRIP + "," + _RAW_VEHICLE_BODY


def _clean(column: str) -> str:
    return f"nullif(trim({column}, ' ' || chr(9) || chr(10) || chr(13)), '')"


_USABLE_TRIP = f"""
usable_trip AS (
  SELECT t.*, md5(coalesce(trip_id, '') || '-' || coalesce(stop_id, '') || '-' || event_type) AS event_key
  FROM (
    SELECT ingested_at, feed_timestamp, source, entity_id,
      {_clean('trip_id')} AS trip_id, {_clean('route_id')} AS route_id,
      {_clean('start_date')} AS start_date, {_clean('start_time')} AS start_time,
      {_clean('stop_id')} AS stop_id, stop_sequence,
      upper({_clean('event_type')}) AS event_type, event_time, delay_sec, schedule_relationship
    FROM raw_trip
    WHERE event_time IS NOT NULL
  ) t
  WHERE route_id IS NOT NULL AND event_type IN ('ARRIVAL', 'DEPARTURE')
)"""


def _newest_trip(name: str, where: str = "TRUE") -> str:
    return f"""
{name} AS (
  SELECT DISTINCT ON (event_key) * FROM usable_trip WHERE {where}
  ORDER BY event_key, ingested_at DESC, feed_timestamp DESC, event_time DESC NULLS LAST, entity_id DESC
)"""


_GOLDEN_COLUMNS = """event_key, route_id, trip_id, stop_id, stop_sequence, event_type, event_time, delay_sec,
    ingested_at, feed_timestamp, CAST(event_time AS DATE) AS event_date,
    CAST(date_trunc('hour', event_time) AS TIMESTAMP) AS event_hour"""


def _golden(name: str, staged: str) -> str:
    return f"""
{name} AS (
  SELECT {_GOLDEN_COLUMNS} FROM {staged} WHERE delay_sec >= -1800 AND delay_sec <= 14400
)"""


_STAGED = _RAW_TRIP + "," + _USABLE_TRIP + "," + _newest_trip("staged")
_EVENTS = _STAGED + "," + _golden("golden", "staged")


def _hourly(name: str, golden: str) -> str:
    return f"""
{name} AS (
  SELECT route_id, event_hour, count(*) AS num_events,
    CAST(sum(delay_sec) AS DOUBLE) / count(*) AS avg_delay_sec,
    quantile_disc(delay_sec, 0.5) AS p50_delay_sec,
    quantile_disc(delay_sec, 0.9) AS p90_delay_sec,
    count(*) FILTER (delay_sec >= 300) AS delayed_5m_events,
    count(*) FILTER (delay_sec >= 300) / count(*) AS pct_events_delayed_5m
  FROM {golden} GROUP BY ALL
)"""


def _daily(name: str, hourly: str) -> str:
    return f"""
{name} AS (
  SELECT route_id, CAST(event_hour AS DATE) AS date_day,
    CAST(sum(num_events) AS BIGINT) AS total_events,
    sum(avg_delay_sec * num_events) / sum(num_events) AS avg_delay_sec,
    CAST(sum(delayed_5m_events) AS BIGINT) AS delayed_5m_events,
    sum(delayed_5m_events) / sum(num_events) AS pct_events_delayed_5m
  FROM {hourly} GROUP BY ALL
)"""


_HOURLY = _EVENTS + "," + _hourly("hourly", "golden")
_DAILY = _HOURLY + "," + _daily("daily", "hourly")

_DIFFERENCES = """
    pct_events_delayed_5m - pct_delayed_prev_day AS dod_pct_delayed,
    pct_events_delayed_5m - pct_delayed_prev_week AS wow_pct_delayed,
    avg_delay_sec - avg_delay_prev_day AS dod_avg_delay_sec,
    avg_delay_sec - avg_delay_prev_week AS wow_avg_delay_sec"""

_COMPARE = _DAILY + f""",
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY date_day) AS n FROM daily
),
compare AS (
  SELECT *, {_DIFFERENCES}
  FROM (
    SELECT c.route_id, c.date_day, c.total_events, c.avg_delay_sec, c.delayed_5m_events, c.pct_events_delayed_5m,
      d.pct_events_delayed_5m AS pct_delayed_prev_day, w.pct_events_delayed_5m AS pct_delayed_prev_week,
      d.avg_delay_sec AS avg_delay_prev_day, w.avg_delay_sec AS avg_delay_prev_week
    FROM numbered c
    LEFT JOIN numbered d ON d.route_id = c.route_id AND d.n = c.n - 1
    LEFT JOIN numbered w ON w.route_id = c.route_id AND w.n = c.n - 7
  )
)"""

_CALENDAR = _DAILY + f""",
calendar AS (
  SELECT *, {_DIFFERENCES}
  FROM (
    SELECT c.*,
      d.pct_events_delayed_5m AS pct_delayed_prev_day, w.pct_events_delayed_5m AS pct_delayed_prev_week,
      d.avg_delay_sec AS avg_delay_prev_day, w.avg_delay_sec AS avg_delay_prev_week
    FROM daily c
    LEFT JOIN daily d ON d.route_id = c.route_id AND d.date_day = c.date_day - 1
    LEFT JOIN daily w ON w.route_id = c.route_id AND w.date_day = c.date_day - 7
  )
)"""

_STAGED_VEHICLE = f"""
usable_vehicle AS (
  SELECT v.*, md5(vehicle_id || '-' || CAST(timestamp AS VARCHAR)) AS vehicle_event_key
  FROM (
    SELECT ingested_at, feed_timestamp, source, entity_id,
      {_clean('vehicle_id')} AS vehicle_id, {_clean('trip_id')} AS trip_id, {_clean('route_id')} AS route_id,
      position_lat, position_lon, bearing, speed, current_status, current_stop_sequence,
      {_clean('stop_id')} AS stop_id, timestamp
    FROM raw_vehicle
    WHERE timestamp IS NOT NULL AND vehicle_id IS NOT NULL
  ) v
),
staged_vehicle AS (
  SELECT DISTINCT ON (vehicle_event_key) * FROM usable_vehicle
  ORDER BY vehicle_event_key, ingested_at DESC, feed_timestamp DESC, entity_id DESC
)"""

_LIVE_BODY = f"""
newest_position AS (
  SELECT DISTINCT ON (vehicle_id) * FROM staged_vehicle
  WHERE position_lat IS NOT NULL AND position_lon IS NOT NULL
  ORDER BY vehicle_id, timestamp DESC
),
newest_delay AS (
  SELECT DISTINCT ON (trip_id) trip_id, delay_sec FROM staged
  WHERE trip_id IS NOT NULL AND delay_sec IS NOT NULL
  ORDER BY trip_id, ingested_at DESC, feed_timestamp DESC, event_time DESC, event_key
),
live AS (
  SELECT p.vehicle_id, p.trip_id, p.route_id, position_lat, position_lon, bearing, speed,
    timestamp AS last_updated_at,
    date_sub('minute', timestamp, {AS_OF}) AS minutes_since_update,
    coalesce(d.delay_sec, 0) AS current_delay_sec
  FROM newest_position p LEFT JOIN newest_delay d ON d.trip_id = p.trip_id
)"""
_STAGED_BOTH = _RAW_BOTH + "," + _USABLE_TRIP + "," + _newest_trip("staged") + "," + _STAGED_VEHICLE
_LIVE = _STAGED_BOTH + "," + _LIVE_BODY

_FRESHNESS = _STAGED + f""",
freshness AS (
  SELECT {AS_OF} AS checked_at, max(feed_timestamp) AS last_feed_timestamp,
    date_sub('hour', max(feed_timestamp), {AS_OF}) AS hours_since_last_feed
  FROM staged
)"""

# One increment after a first load up to and including the cutoff.
_INCREMENT = (
    _RAW_TRIP + "," + _USABLE_TRIP + "," + _newest_trip("staged_old", f"ingested_at <= {CUTOFF}")
    + "," + _golden("target", "staged_old")
    + "," + _newest_trip("staged_new", "ingested_at > (SELECT max(ingested_at) FROM target)")
    + "," + _golden("delta", "staged_new")
    + """,
merged AS (
  SELECT * FROM target WHERE event_key NOT IN (SELECT event_key FROM delta)
  UNION ALL SELECT * FROM delta
)"""
)

# Three arrivals of raw data, each staged and cleaned on its own; the newest load wins.
_REPLAY = (
    _RAW_TRIP + "," + _USABLE_TRIP + f""",
sliced AS (
  SELECT DISTINCT ON (event_key, slice) *
  FROM (
    SELECT *, CASE WHEN ingested_at < {SLICES[0]} THEN 1 WHEN ingested_at < {SLICES[1]} THEN 2 ELSE 3 END AS slice
    FROM usable_trip
  )
  ORDER BY event_key, slice, ingested_at DESC, feed_timestamp DESC, event_time DESC, entity_id DESC
),
kept AS (
  SELECT DISTINCT ON (event_key) * FROM sliced WHERE delay_sec >= -1800 AND delay_sec <= 14400
  ORDER BY event_key, slice DESC
)"""
    + "," + _golden("replayed", "kept")
)


# All models of a project built from two arrivals, the events by increments.
_PROJECT = (
    _STAGED_BOTH
    + "," + _newest_trip("staged_old", f"ingested_at < {CUTOFF}")
    + "," + _golden("target", "staged_old")
    + "," + _newest_trip("staged_new", "ingested_at > (SELECT max(ingested_at) FROM target)")
    + "," + _golden("delta", "staged_new")
    + """,
merged AS (
  SELECT * FROM target WHERE event_key NOT IN (SELECT event_key FROM delta)
  UNION ALL SELECT * FROM delta
),"""
    + _hourly("hourly", "merged") + "," + _daily("daily", "hourly") + _COMPARE.removeprefix(_DAILY)
    + "," + _LIVE_BODY + _FRESHNESS.removeprefix(_STAGED)
)
_ROLLING_BODY = """SELECT c.route_id, c.date_day, round(avg(b.pct_events_delayed_5m), 6) AS pct_delayed_7d_avg,
  round(avg(b.avg_delay_sec), 6) AS avg_delay_7d_avg
FROM (SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY date_day) AS n FROM daily) c
JOIN (SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY date_day) AS n FROM daily) b
  ON b.route_id = c.route_id AND b.n BETWEEN c.n - 6 AND c.n
GROUP BY c.route_id, c.date_day"""


def _project_rows() -> str:
    """Every stored row as text: model, and the values of its columns in alphabetical order of
    their names. Timestamps have six digits, doubles six decimals, nulls are a tilde."""

    def text(column: str, kind: str) -> str:
        shown = {
            "timestamp_ntz": f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')",
            "double": f"CAST(CAST(round({column}, 6) AS DECIMAL(18, 6)) AS VARCHAR)",
        }.get(kind, f"CAST({column} AS VARCHAR)")
        return f"coalesce({shown}, '~')"

    relations = {
        "stg_trip_updates": "staged",
        "stg_vehicle_positions": "staged_vehicle",
        "int_trip_stop_events_deduped": "merged",
        "int_route_delay_hourly": "hourly",
        "dim_route": "(SELECT DISTINCT route_id FROM merged WHERE route_id IS NOT NULL)",
        "dim_date": """(SELECT DISTINCT event_date AS date_day, year(event_date) AS year, month(event_date) AS month,
  day(event_date) AS day, dayofweek(event_date) + 1 AS day_of_week, dayname(event_date) AS day_name FROM merged)""",
        "fct_route_delay_hourly": f"({_MART_HOURLY.format('hourly')})",
        "fct_route_delay_daily": "daily",
        "fct_route_delay_daily_compare": "compare",
        "fct_route_delay_daily_rolling": f"({_ROLLING_BODY})",
        "fct_latest_vehicle_positions": "live",
        "mart_data_freshness": "freshness",
    }
    parts = []
    for model, relation in relations.items():
        columns = sorted(field.split() for field in MODELS[model].split(", "))
        line = " || '|' || ".join(text(name, kind) for name, kind in columns)
        parts.append(f"SELECT '{model}' AS model, {line} AS stored FROM {relation}")
    return _select(_PROJECT, "\nUNION ALL ".join(parts))


# Every cleaned prediction, usable or not.
_KEYED = (
    _RAW_TRIP + f""",
keyed AS (
  SELECT *, md5(coalesce(trip_id, '') || '-' || coalesce(stop_id, '') || '-' || coalesce(event_type, '')) AS event_key
  FROM (
    SELECT entity_id, {_clean('trip_id')} AS trip_id, {_clean('route_id')} AS route_id, {_clean('stop_id')} AS stop_id,
      upper(trim(event_type)) AS event_type, event_time
    FROM raw_trip
  )
)"""
)

# Three batches of pings; each is late where it is ten days older than all earlier batches.
_SORTED = (
    _RAW_VEHICLE + "," + _STAGED_VEHICLE + """,
batched AS (
  SELECT *, CAST(entity_id AS BIGINT) % 3 AS batch, least(timestamp, ingested_at) AS seen_at
  FROM usable_vehicle WHERE vehicle_event_key IS NOT NULL
),
newest AS (SELECT batch, max(seen_at) AS newest FROM batched GROUP BY batch),
judged AS (
  SELECT b.*, coalesce(seen_at < (SELECT max(newest) FROM newest n WHERE n.batch < b.batch) - INTERVAL 10 DAY, FALSE) AS is_late
  FROM batched b
),
first_copies AS (
  SELECT DISTINCT ON (vehicle_event_key) * FROM judged WHERE NOT is_late
  ORDER BY vehicle_event_key, batch, ingested_at, feed_timestamp, entity_id
)"""
)


def _select(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


def _rounded(ctes: str, relation: str, *doubles: str) -> str:
    replaced = ", ".join(f"round({c}, 6) AS {c}" for c in doubles)
    return _select(ctes, f"SELECT * REPLACE ({replaced}) FROM {relation}")


_HOURLY_DOUBLES = ("avg_delay_sec", "pct_events_delayed_5m")
_COMPARE_DOUBLES = (
    "avg_delay_sec", "pct_events_delayed_5m", "pct_delayed_prev_day", "pct_delayed_prev_week",
    "avg_delay_prev_day", "avg_delay_prev_week", "dod_pct_delayed", "wow_pct_delayed",
    "dod_avg_delay_sec", "wow_avg_delay_sec",
)
_MART_HOURLY = """SELECT route_id, event_hour, CAST(event_hour AS DATE) AS date_day, num_events,
  round(avg_delay_sec, 6) AS avg_delay_sec, p50_delay_sec, p90_delay_sec, delayed_5m_events,
  round(pct_events_delayed_5m, 6) AS pct_events_delayed_5m FROM {}"""
_PIVOT = ", ".join(
    f"round(sum(avg_delay_sec * num_events) FILTER (hour(event_hour) = {h})"
    f" / sum(num_events) FILTER (hour(event_hour) = {h}), 6) AS h{h:02d}"
    for h in range(24)
)


# Model, column and test of every declared check.
_DECLARED = """
stg_trip_updates|event_key|unique
stg_trip_updates|event_key|not_null
stg_trip_updates|event_time|not_null
stg_trip_updates|event_type|accepted_values
stg_trip_updates|trip_id|not_null
stg_trip_updates|route_id|not_null
stg_vehicle_positions|vehicle_event_key|unique
stg_vehicle_positions|vehicle_event_key|not_null
stg_vehicle_positions|vehicle_id|not_null
stg_vehicle_positions|timestamp|not_null
int_trip_stop_events_deduped|event_key|unique
int_trip_stop_events_deduped|event_key|not_null
int_trip_stop_events_deduped|route_id|not_null
int_trip_stop_events_deduped|event_time|not_null
int_route_delay_hourly|route_id|not_null
int_route_delay_hourly|event_hour|not_null
dim_route|route_id|not_null
dim_route|route_id|unique
dim_date|date_day|not_null
dim_date|date_day|unique
fct_route_delay_hourly|route_id, event_hour|unique
fct_route_delay_hourly|route_id|not_null
fct_route_delay_hourly|event_hour|not_null
fct_route_delay_daily|route_id|not_null
fct_route_delay_daily|date_day|not_null
fct_route_delay_daily_compare|route_id|not_null
fct_route_delay_daily_compare|date_day|not_null
fct_latest_vehicle_positions|vehicle_id|not_null
fct_latest_vehicle_positions|vehicle_id|unique
"""


def _checks() -> str:
    relations = {
        "stg_trip_updates": "staged",
        "stg_vehicle_positions": "staged_vehicle",
        "int_trip_stop_events_deduped": "golden",
        "int_route_delay_hourly": "hourly",
        "fct_route_delay_hourly": "hourly",
        "fct_route_delay_daily": "daily",
        "fct_route_delay_daily_compare": "daily",
        "fct_latest_vehicle_positions": "live",
        "dim_route": "(SELECT DISTINCT route_id FROM golden WHERE route_id IS NOT NULL)",
        "dim_date": "(SELECT DISTINCT event_date AS date_day FROM golden)",
    }
    parts = []
    for model, named, test in (line.split("|") for line in _DECLARED.split("\n") if line):
        relation = relations[model]
        column = {"route_id, event_hour": "route_id || '-' || event_hour"}.get(named, named)
        failing = {
            "not_null": f"SELECT 1 FROM {relation} WHERE {column} IS NULL",
            "unique": f"SELECT {column} FROM {relation} WHERE {column} IS NOT NULL GROUP BY ALL HAVING count(*) > 1",
            "accepted_values": f"SELECT 1 FROM {relation} WHERE {column} NOT IN ('ARRIVAL', 'DEPARTURE')",
        }[test]
        parts.append(
            f"SELECT '{model}' AS model, '{named}' AS \"column\", '{test}' AS test, "
            f"count(*) AS failures FROM ({failing})"
        )
    ctes = (
        _STAGED_BOTH + "," + _golden("golden", "staged") + "," + _hourly("hourly", "golden")
        + "," + _daily("daily", "hourly") + "," + _LIVE_BODY
    )
    return _select(ctes, "\nUNION ALL ".join(parts))


def statements() -> dict[str, str]:
    return {
        "raw_trip_updates": _select(_RAW_TRIP, "SELECT * FROM raw_trip"),
        "raw_vehicle_positions": _select(_RAW_VEHICLE, "SELECT * FROM raw_vehicle"),
        "flatten_trip_updates": _select(
            _RAW_TRIP,
            """SELECT ingested_at, feed_timestamp, 'gtfs_rt_trip_updates' AS source, entity_id, trip_id, route_id,
  start_date, start_time, stop_id, stop_sequence, upper(trim(event_type)) AS event_type,
  CAST(date_trunc('second', event_time) AS TIMESTAMP) AS event_time, delay_sec, schedule_relationship, raw_json
FROM raw_trip WHERE event_time IS NOT NULL AND event_type <> 'SKIPPED'""",
        ),
        "flatten_vehicle_positions": _select(
            _RAW_VEHICLE,
            """SELECT * REPLACE ('gtfs_rt_vehicle_positions' AS source, coalesce(position_lat, 0.0::DOUBLE) AS position_lat)
FROM raw_vehicle""",
        ),
        "stg_trip_updates": _select(_STAGED, "SELECT * FROM staged"),
        "stg_vehicle_positions": _select(_RAW_VEHICLE + "," + _STAGED_VEHICLE, "SELECT * FROM staged_vehicle"),
        "int_trip_stop_events_deduped": _select(_EVENTS, "SELECT * FROM golden"),
        "incremental_upsert": _select(_INCREMENT, "SELECT * FROM merged"),
        "int_route_delay_hourly": _rounded(_HOURLY, "hourly", *_HOURLY_DOUBLES),
        "fct_route_delay_hourly": _select(_HOURLY, _MART_HOURLY.format("hourly")),
        "fct_route_delay_daily": _rounded(_DAILY, "daily", *_HOURLY_DOUBLES),
        "fct_route_delay_daily_compare": _rounded(_COMPARE, "compare", *_COMPARE_DOUBLES),
        "fct_route_delay_daily_compare_calendar": _rounded(_CALENDAR, "calendar", *_COMPARE_DOUBLES),
        "fct_route_delay_daily_rolling": _select(
            _DAILY,
            _ROLLING_BODY,
        ),
        "dim_route": _select(_EVENTS, "SELECT DISTINCT route_id FROM golden WHERE route_id IS NOT NULL"),
        "dim_date": _select(
            _EVENTS,
            """SELECT DISTINCT event_date AS date_day, CAST(year(event_date) AS INTEGER) AS year,
  CAST(month(event_date) AS INTEGER) AS month, CAST(day(event_date) AS INTEGER) AS day,
  CAST(dayofweek(event_date) + 1 AS INTEGER) AS day_of_week, dayname(event_date) AS day_name FROM golden""",
        ),
        "fct_latest_vehicle_positions": _select(_LIVE, "SELECT * FROM live"),
        "mart_data_freshness": _select(_FRESHNESS, "SELECT * FROM freshness"),
        "freshness_alert": _select(
            _FRESHNESS,
            """SELECT *, date_sub('minute', last_feed_timestamp, checked_at) AS minutes_since_last_feed,
  date_sub('minute', last_feed_timestamp, checked_at) > 120 AS is_stale FROM freshness""",
        ),
        "source_freshness": _select(
            _RAW_BOTH,
            "\nUNION ALL ".join(
                f"""SELECT '{name}' AS source_table, max(ingested_at) AS max_loaded_at,
  date_sub('minute', max(ingested_at), {AS_OF}) AS age_minutes,
  CASE WHEN max(ingested_at) < {AS_OF} - INTERVAL '60' MINUTE THEN 'warn' ELSE 'pass' END AS status
FROM {relation}"""
                for name, relation in (("raw_trip_updates", "raw_trip"), ("raw_vehicle_positions", "raw_vehicle"))
            ),
        ),
        "network_avg_delay": _select(
            _DAILY,
            """SELECT CAST(sum(total_events) AS BIGINT) AS total_events,
  round(sum(avg_delay_sec * total_events) / sum(total_events), 6) AS avg_delay_sec FROM daily""",
        ),
        "daily_delay_trend": _select(
            _DAILY,
            """SELECT date_day, CAST(sum(total_events) AS BIGINT) AS total_events,
  round(sum(avg_delay_sec * total_events) / sum(total_events), 6) AS avg_delay_sec FROM daily GROUP BY date_day""",
        ),
        "daily_delay_trend_compare": _select(
            _DAILY + """,
trend AS (
  SELECT date_day, CAST(sum(total_events) AS BIGINT) AS total_events,
    sum(avg_delay_sec * total_events) / sum(total_events) AS avg_delay_sec FROM daily GROUP BY date_day
)""",
            """SELECT t.date_day, t.total_events, round(t.avg_delay_sec, 6) AS avg_delay_sec,
  round(e.avg_delay_sec, 6) AS avg_delay_prev_week, round(t.avg_delay_sec - e.avg_delay_sec, 6) AS wow_avg_delay_sec
FROM trend t LEFT JOIN trend e ON e.date_day = t.date_day - INTERVAL 7 DAY""",
        ),
        "hourly_intensity_pivot": _select(_HOURLY, f"SELECT route_id, {_PIVOT} FROM hourly GROUP BY route_id"),
        "delay_heatmap_grid": _select(
            _LIVE,
            """SELECT CAST(floor(position_lat * 100) AS BIGINT) AS lat_cell, CAST(floor(position_lon * 100) AS BIGINT) AS lon_cell,
  count(*) AS vehicles, CAST(sum(current_delay_sec) AS BIGINT) AS total_delay_sec,
  round(CAST(sum(current_delay_sec) AS DOUBLE) / count(*), 6) AS avg_delay_sec FROM live GROUP BY ALL""",
        ),
        "active_vehicles_now": _select(
            _LIVE.replace(AS_OF, AFTER_MIDNIGHT),
            "SELECT * FROM live WHERE minutes_since_update BETWEEN 0 AND 20",
        ),
        "raw_vehicle_log": _select(_RAW_VEHICLE, f"SELECT * FROM raw_vehicle WHERE ingested_at >= {CUTOFF}"),
        "active_vehicles": _select(_LIVE, "SELECT * FROM live WHERE minutes_since_update <= 2880"),
        "worst_delays_topk": _select(
            _LIVE,
            "SELECT * FROM live WHERE vehicle_id IS NOT NULL ORDER BY current_delay_sec DESC, vehicle_id LIMIT 10",
        ),
        "routes_getting_slower": _select(
            _COMPARE,
            """SELECT route_id, date_day, round(avg_delay_sec, 6) AS avg_delay_sec,
  round(avg_delay_prev_week, 6) AS avg_delay_prev_week, round(wow_avg_delay_sec, 6) AS wow_avg_delay_sec
FROM compare WHERE wow_avg_delay_sec > 0""",
        ),
        "route_delay_percentiles": _select(
            _EVENTS,
            "\nUNION ALL ".join(
                f"""SELECT route_id, '{period}' AS period, CAST(date_trunc('{period}', event_date) AS DATE) AS first_day,
  count(*) AS num_events, quantile_disc(delay_sec, 0.5) AS p50_delay_sec, quantile_disc(delay_sec, 0.9) AS p90_delay_sec
FROM golden WHERE route_id IS NOT NULL AND delay_sec IS NOT NULL GROUP BY ALL"""
                for period in ("day", "week")
            ),
        ),
        "dq_results": _checks(),
        "stream_feed_ingest": _select(
            _RAW_TRIP,
            """SELECT feed_timestamp, 'gtfs_rt_trip_updates' AS source, entity_id, trip_id, route_id,
  start_date, start_time, stop_id, stop_sequence, upper(trim(event_type)) AS event_type,
  CAST(date_trunc('second', event_time) AS TIMESTAMP) AS event_time, delay_sec, schedule_relationship, raw_json
FROM raw_trip WHERE event_time IS NOT NULL AND event_type <> 'SKIPPED'""",
        ),
        "stream_live_replay": _select(_LIVE, "SELECT * FROM live"),
        "stream_dq_totals": _select(
            _KEYED + "," + _RAW_VEHICLE_BODY + "," + _STAGED_VEHICLE,
            """SELECT 'stg_trip_updates' AS model, * FROM (
  SELECT 'event_key' AS "column", 'unique' AS test, count(*) AS failures
  FROM (SELECT event_key FROM keyed GROUP BY event_key HAVING count(*) > 1)
  UNION ALL SELECT 'event_key', 'not_null', count(*) FROM keyed WHERE event_key IS NULL
  UNION ALL SELECT 'event_time', 'not_null', count(*) FROM keyed WHERE event_time IS NULL
  UNION ALL SELECT 'event_type', 'accepted_values', count(*) FROM keyed WHERE event_type NOT IN ('ARRIVAL', 'DEPARTURE')
  UNION ALL SELECT 'trip_id', 'not_null', count(*) FROM keyed WHERE trip_id IS NULL
  UNION ALL SELECT 'route_id', 'not_null', count(*) FROM keyed WHERE route_id IS NULL
)
UNION ALL SELECT 'stg_vehicle_positions', * FROM (
  SELECT 'vehicle_event_key', 'unique', count(*)
  FROM (SELECT vehicle_event_key FROM usable_vehicle WHERE vehicle_event_key IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'vehicle_event_key', 'not_null', count(*) FROM usable_vehicle WHERE vehicle_event_key IS NULL
  UNION ALL SELECT 'vehicle_id', 'not_null', count(*) FROM usable_vehicle WHERE vehicle_id IS NULL
  UNION ALL SELECT 'timestamp', 'not_null', count(*) FROM usable_vehicle WHERE timestamp IS NULL
)""",
        ),
        "stream_quarantine": _select(
            _KEYED,
            """SELECT entity_id, event_key, trip_id, route_id, concat_ws(', ',
  CASE WHEN event_time IS NULL THEN 'not_null(event_time)' END,
  CASE WHEN event_type NOT IN ('ARRIVAL', 'DEPARTURE') THEN 'accepted_values(event_type)' END,
  CASE WHEN trip_id IS NULL THEN 'not_null(trip_id)' END,
  CASE WHEN route_id IS NULL THEN 'not_null(route_id)' END) AS failed
FROM keyed
WHERE event_time IS NULL OR event_type NOT IN ('ARRIVAL', 'DEPARTURE') OR trip_id IS NULL OR route_id IS NULL""",
        ),
        "flatten_trip_polls": _select(
            _RAW_TRIP + """,
stops AS (
  SELECT r.feed_timestamp, e.user_id, e.event_id, r.stop_id, r.stop_sequence, coalesce(r.delay_sec, 0) AS delay,
    CAST(date_trunc('second', r.event_time) AS TIMESTAMP) AS called
  FROM raw_trip r JOIN events e ON CAST(e.event_id AS VARCHAR) = r.entity_id
  WHERE r.event_time IS NOT NULL
),
calls AS (
  SELECT *, 'ARRIVAL' AS event_type, called AS event_time, delay AS delay_sec FROM stops WHERE event_id % 3 <> 1
  UNION ALL
  SELECT *, 'DEPARTURE', called + INTERVAL 40 SECOND, delay + 10 FROM stops WHERE event_id % 3 <> 0
)""",
            """SELECT feed_timestamp, 'gtfs_rt_trip_updates' AS source, 'E' || user_id AS entity_id, 'T' || user_id AS trip_id,
  'R' || (user_id % 12) AS route_id, strftime(feed_timestamp, '%Y%m%d') AS start_date, '08:00:00' AS start_time,
  stop_id, stop_sequence, event_type, event_time, nullif(delay_sec, 0) AS delay_sec,
  CAST(user_id % 4 AS VARCHAR) AS schedule_relationship, CAST(NULL AS VARCHAR) AS raw_json
FROM calls""",
        ),
        "flatten_vehicle_polls": _select(
            _RAW_VEHICLE,
            """SELECT * EXCLUDE (ingested_at)
  REPLACE ('gtfs_rt_vehicle_positions' AS source, coalesce(position_lat, 0.0::DOUBLE) AS position_lat)
FROM raw_vehicle""",
        ),
        "stream_freshness_notes": _select(_FRESHNESS, "SELECT * FROM freshness"),
        "stream_distinct_pings": _select(_SORTED, "SELECT * EXCLUDE (batch, seen_at, is_late) FROM first_copies"),
        "stream_ping_account": _select(
            _SORTED,
            """SELECT a.batch, a.arrived, k.kept, j.usable - k.kept - j.late AS repeated, j.late, a.arrived - j.usable AS unusable,
  n.newest
FROM (SELECT CAST(entity_id AS BIGINT) % 3 AS batch, count(*) AS arrived FROM raw_vehicle GROUP BY 1) a
JOIN (SELECT batch, count(*) AS usable, count(*) FILTER (is_late) AS late FROM judged GROUP BY batch) j USING (batch)
JOIN (SELECT batch, count(*) AS kept FROM first_copies GROUP BY batch) k USING (batch)
JOIN newest n USING (batch)""",
        ),
        "project_build": _select(_LIVE, "SELECT * FROM live"),
        "project_models": _project_rows(),
        "freshness_now": _select(
            _STAGED,
            """SELECT max(feed_timestamp) AS last_feed_timestamp,
  date_sub('day', max(feed_timestamp), make_timestamp(epoch_us(now()))) AS days_since_last_feed,
  date_sub('minute', max(feed_timestamp), make_timestamp(epoch_us(now()))) > 120 AS is_stale FROM staged""",
        ),
        "mixed_log_append": _select(
            _RAW_TRIP,
            """SELECT feed_timestamp, 'gtfs_rt_trip_updates' AS source, entity_id, trip_id, route_id,
  start_date, start_time, stop_id, stop_sequence, upper(trim(event_type)) AS event_type,
  CAST(date_trunc('second', event_time) AS TIMESTAMP) AS event_time, delay_sec, schedule_relationship, raw_json
FROM raw_trip WHERE event_time IS NOT NULL AND event_type <> 'SKIPPED'""",
        ),
        "stream_vehicle_ingest": _select(
            _RAW_VEHICLE,
            """SELECT * EXCLUDE (ingested_at)
  REPLACE ('gtfs_rt_vehicle_positions' AS source, coalesce(position_lat, 0.0::DOUBLE) AS position_lat)
FROM raw_vehicle""",
        ),
        "feed_rejects": _select(
            _RAW_TRIP,
            """SELECT outcome, count(*) AS n FROM (
  SELECT CASE WHEN CAST(entity_id AS BIGINT) % 10 = 0 THEN 'unreadable' ELSE 'not a number' END AS outcome
  FROM raw_trip WHERE CAST(entity_id AS BIGINT) % 10 IN (0, 3)
  UNION ALL
  SELECT CASE WHEN CAST(entity_id AS BIGINT) % 10 = 2 THEN 'kept as 3' ELSE 'kept as 0' END
  FROM raw_trip
  WHERE CAST(entity_id AS BIGINT) % 10 NOT IN (0, 3) AND event_time IS NOT NULL AND event_type <> 'SKIPPED'
) GROUP BY outcome""",
        ),
        "failing_rows": _select(_STAGED, "SELECT event_key, route_id, entity_id FROM staged WHERE trip_id IS NULL"),
        "stream_hourly_windows": _rounded(
            _HOURLY,
            "hourly",
            *_HOURLY_DOUBLES,
        ),
        "stream_golden_replay": _select(_REPLAY, "SELECT * FROM replayed"),
        "stream_hourly_replay": _select(
            _REPLAY + "," + _hourly("hourly", "replayed"), _MART_HOURLY.format("hourly")
        ),
        "stream_daily_replay": _rounded(
            _REPLAY + "," + _hourly("hourly", "replayed") + "," + _daily("daily", "hourly"), "daily", *_HOURLY_DOUBLES
        ),
    }
