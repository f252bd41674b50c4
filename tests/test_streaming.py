"""Streams against the batch models."""

from __future__ import annotations

import datetime as dt
import json
import re

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import AS_OF, SF_SMALL, as_set
from headway import schemas
from headway.functions import utc_literal
from headway.plans import delays, fleet, increments, live
from headway.plans.events import int_trip_stop_events_deduped
from headway.plans.freshness import mart_data_freshness
from headway.plans.staging import stg_trip_updates, stg_vehicle_positions
from headway.sources import event_stream
from headway.sources.feeds import flatten_trip_updates, flatten_vehicle_positions, read_feed, split_feed
from headway.sources.ingest import run_ingest
from headway.sources.raw_log import append_raw, read_raw
from headway.sources.scratch import new_folder
from headway.streaming import fleet as fleet_stream
from headway.streaming import pings, route_metrics
from headway.streaming.feeds import read_log_stream, stream_trip_feed, stream_vehicle_feed
from headway.streaming.route_metrics import hourly_windows, stream_route_metrics


@pytest.fixture
def folder(spark):
    return new_folder(spark, "test")


@pytest.fixture
def source(spark):
    return event_stream.read_events(spark, SF_SMALL)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def without_batch_time(df):
    return df.drop("ingested_at")


def test_feed_files_become_raw_rows(spark, folder, source):
    trips, vehicles = event_stream.trip_feed(source), event_stream.vehicle_feed(source)
    halves = (F.col("ingested_at") < utc_literal("2024-01-15 00:00:00"), F.col("ingested_at") >= utc_literal("2024-01-15 00:00:00"))
    counts = []
    for half in halves:
        trips.where(half).drop("ingested_at").write.mode("append").json(f"{folder}/trips")
        vehicles.where(half).drop("ingested_at").write.mode("append").json(f"{folder}/vehicles")
        finish(stream_trip_feed(spark, f"{folder}/trips", f"{folder}/log", f"{folder}/c1"))
        finish(stream_vehicle_feed(spark, f"{folder}/vehicles", f"{folder}/vlog", f"{folder}/c2"))
        log = read_raw(spark, f"{folder}/log", schemas.RAW_TRIP_UPDATES)
        counts.append(log.select("ingested_at").distinct().count())
    assert counts == [1, 2]  # one ingestion time per micro-batch
    assert as_set(without_batch_time(log)) == as_set(without_batch_time(flatten_trip_updates(trips)))
    vlog = read_raw(spark, f"{folder}/vlog", schemas.RAW_VEHICLE_POSITIONS)
    assert as_set(without_batch_time(vlog)) == as_set(without_batch_time(flatten_vehicle_positions(vehicles)))


def test_batch_ingest_counts(spark, folder, source):
    event_stream.trip_feed(source).write.json(f"{folder}/trips")
    feed = read_feed(spark, f"{folder}/trips", schemas.TRIP_FEED)
    counts = run_ingest(feed, event_stream.vehicle_feed(source), f"{folder}/log", f"{folder}/vlog", AS_OF)
    log = read_raw(spark, f"{folder}/log", schemas.RAW_TRIP_UPDATES)
    assert counts == {"trip_rows": log.count(), "vehicle_rows": 1000}
    assert log.select("ingested_at").distinct().count() == 1


def test_route_metrics_follow_the_log(spark, folder, source):
    raw = event_stream.raw_trip_updates(source)
    batch = increments.events_table(spark, f"{folder}/batch")
    for low, high in (("2024-01-01", "2024-01-12"), ("2024-01-12", "2024-02-01")):
        arrived = (F.col("ingested_at") >= utc_literal(f"{low} 00:00:00")) & (F.col("ingested_at") < utc_literal(f"{high} 00:00:00"))
        append_raw(raw.where(arrived), f"{folder}/log")
        finish(stream_route_metrics(spark, f"{folder}/log", folder, f"{folder}/progress"))
        increments.load_new_events(batch, f"{folder}/log")
    events = increments.events_table(spark, folder)
    assert as_set(events.read()) == as_set(batch.read())
    hourly = delays.fct_route_delay_hourly(delays.int_route_delay_hourly(batch.read()))
    assert as_set(increments.hourly_table(spark, folder).read()) == as_set(hourly)


def test_batch_interrupted_between_tables_is_repeated(spark, folder, trip_rows, monkeypatch):
    append_raw(trip_rows({}, {"stop_id": "s2"}), f"{folder}/log")
    finish(stream_route_metrics(spark, f"{folder}/log", folder, f"{folder}/progress"))
    append_raw(trip_rows({"ingested_at": "10 08:40", "event_time": "11 01:00", "delay_sec": 5}), f"{folder}/log")

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(route_metrics, "refresh_metrics", lost)
        with pytest.raises(StreamingQueryException):
            stream_route_metrics(spark, f"{folder}/log", folder, f"{folder}/progress").awaitTermination()
    events, daily = increments.events_table(spark, folder), increments.daily_table(spark, folder)
    assert events.read().count() == 2
    assert as_set(daily.read(), "date_day", "total_events") == {(dt.date(2024, 1, 10), 2)}
    finish(stream_route_metrics(spark, f"{folder}/log", folder, f"{folder}/progress"))
    assert as_set(daily.read(), "date_day", "total_events") == {(dt.date(2024, 1, 10), 1), (dt.date(2024, 1, 11), 1)}
    assert as_set(events.read(), "stop_id", "delay_sec") == {("s1", 5), ("s2", 100)}


def follow_live(spark, folder, **options):
    finish(fleet_stream.stream_trip_delays(spark, f"{folder}/log", folder, f"{folder}/c3"))
    finish(fleet_stream.stream_positions(spark, f"{folder}/vlog", folder, f"{folder}/c4", **options))


def test_fleet_streams_equal_the_batch_model(spark, folder, source):
    updates, vehicles = event_stream.raw_trip_updates(source), event_stream.raw_vehicle_positions(source)
    monitor = fleet_stream.FreshnessMonitor(spark, folder)
    spark.streams.addListener(monitor)
    for low, high in (("2024-01-01", "2024-01-12"), ("2024-01-12", "2024-02-01")):
        arrived = (F.col("ingested_at") >= utc_literal(f"{low} 00:00:00")) & (F.col("ingested_at") < utc_literal(f"{high} 00:00:00"))
        append_raw(updates.where(arrived), f"{folder}/log")
        append_raw(vehicles.where(arrived), f"{folder}/vlog")
        query = fleet_stream.stream_staged_updates(spark, f"{folder}/log", folder, f"{folder}/c1")
        finish(query)
        monitor.wait(query)
        finish(fleet_stream.stream_staged_pings(spark, f"{folder}/vlog", folder, f"{folder}/c2"))
        follow_live(spark, folder)
    spark.streams.removeListener(monitor)
    expected = fleet.fct_latest_vehicle_positions(stg_vehicle_positions(vehicles), stg_trip_updates(updates), AS_OF)
    assert as_set(live.live_fleet(spark, folder, AS_OF)) == as_set(expected)
    files = live.live_fleet(spark, folder, AS_OF).inputFiles()
    assert {f.split(folder)[1].split("/")[1] for f in files} == {"live_positions", "live_trip_delays"}
    staged = increments.staged_updates_table(spark, folder).read()
    assert as_set(staged) == as_set(stg_trip_updates(updates))
    assert as_set(increments.staged_pings_table(spark, folder).read()) == as_set(stg_vehicle_positions(vehicles))
    notes = spark.read.parquet(f"{folder}/freshness")
    assert [r.batch for r in notes.orderBy("batch").collect()] == [0, 1]
    assert as_set(fleet_stream.noted_freshness(spark, folder, AS_OF)) == as_set(mart_data_freshness(staged, AS_OF))


def test_a_later_copy_takes_a_position_or_a_delay_back(spark, folder, trip_rows, ping_rows):
    """What a copy without coordinates or delay hides shows what was there before."""
    append_raw(trip_rows({}, {"stop_id": "s2", "delay_sec": 50, "event_time": "10 08:00"}), f"{folder}/log")
    append_raw(ping_rows({}, {"timestamp": "10 08:10", "speed": 1.0}, {"vehicle_id": " ", "speed": 2.0}), f"{folder}/vlog")
    follow_live(spark, folder)
    shown = "vehicle_id", "speed", "current_delay_sec"
    assert as_set(live.live_fleet(spark, folder, AS_OF), *shown) == {("v1", 10.0, 100), (None, 2.0, 100)}
    append_raw(trip_rows({"ingested_at": "10 08:40", "delay_sec": None}), f"{folder}/log")
    append_raw(ping_rows({"ingested_at": "10 08:40", "position_lat": None}, {"vehicle_id": "v2", "trip_id": None}), f"{folder}/vlog")
    follow_live(spark, folder)
    assert as_set(live.live_fleet(spark, folder, AS_OF), *shown) == {("v1", 1.0, 50), (None, 2.0, 50), ("v2", 10.0, 0)}
    # An older copy that comes late changes nothing.
    append_raw(ping_rows({"ingested_at": "10 08:30", "speed": 99.0}), f"{folder}/vlog")
    append_raw(trip_rows({"ingested_at": "10 08:30", "delay_sec": 99}), f"{folder}/log")
    follow_live(spark, folder)
    assert as_set(live.live_fleet(spark, folder, AS_OF), *shown) == {("v1", 1.0, 50), (None, 2.0, 50), ("v2", 10.0, 0)}


def test_settled_pings_leave_but_their_position_stays(spark, folder, ping_rows, trip_rows):
    append_raw(trip_rows({}), f"{folder}/log")
    days = [{"timestamp": f"{d} 08:00", "ingested_at": f"{d} 08:10", "speed": float(d)} for d in range(10, 16)]
    ahead = {"vehicle_id": "fast", "timestamp": "30 08:00", "ingested_at": "10 08:10"}
    quiet = {"vehicle_id": "quiet", "timestamp": "10 07:00", "ingested_at": "10 07:10"}
    finish(fleet_stream.stream_trip_delays(spark, f"{folder}/log", folder, f"{folder}/c3"))
    for batch in ([days[0], ahead, quiet], *([d] for d in days[1:])):
        append_raw(ping_rows(*batch), f"{folder}/vlog")
        finish(fleet_stream.stream_positions(spark, f"{folder}/vlog", folder, f"{folder}/c4"))
    held = live.pings_table(spark, folder).read()
    assert held.where("vehicle_id = 'v1'").count() == 5 and held.count() == 7
    assert as_set(live.live_fleet(spark, folder, AS_OF), "vehicle_id", "speed") == {("v1", 15.0), ("fast", 10.0), ("quiet", 10.0)}
    # The watermark refuses a copy of a settled ping.
    append_raw(ping_rows({**days[0], "ingested_at": "15 08:20", "vehicle_id": "quiet"}), f"{folder}/vlog")
    finish(fleet_stream.stream_positions(spark, f"{folder}/vlog", folder, f"{folder}/c4"))
    assert live.pings_table(spark, folder).read().where("vehicle_id = 'quiet'").count() == 1


def test_snapshot_that_missed_a_change_is_caught_up(spark, folder, trip_rows, monkeypatch):
    append_raw(trip_rows({}, {"trip_id": "t2"}), f"{folder}/log")
    finish(fleet_stream.stream_trip_delays(spark, f"{folder}/log", folder, f"{folder}/c3"))

    def lost(*_):
        raise RuntimeError("driver lost")

    append_raw(trip_rows({"ingested_at": "10 08:40", "delay_sec": 5}), f"{folder}/log")
    with monkeypatch.context() as patched:
        patched.setattr(live, "_refresh", lost)
        with pytest.raises(StreamingQueryException):
            fleet_stream.stream_trip_delays(spark, f"{folder}/log", folder, f"{folder}/c3").awaitTermination()
    append_raw(trip_rows({"ingested_at": "10 08:50", "trip_id": "t3", "delay_sec": 6}), f"{folder}/log")
    finish(fleet_stream.stream_trip_delays(spark, f"{folder}/log", folder, f"{folder}/c3"))
    assert as_set(live.trip_delays_table(spark, folder).read()) == {("t1", 5), ("t2", 100), ("t3", 6)}


def test_pings_are_kept_or_accounted_for(spark, folder, ping_rows):
    week = dt.timedelta(days=7)
    batches = [
        ping_rows({"speed": 1.0}, {"speed": 2.0, "ingested_at": "10 08:30"}, {"vehicle_id": " "}, {"vehicle_id": None}, {"timestamp": None}),
        ping_rows({"speed": 3.0, "ingested_at": "10 08:40"}, {"timestamp": "20 08:00", "ingested_at": "20 08:20"}),
        ping_rows({"ingested_at": "20 08:30"}, {"timestamp": "14 08:00", "ingested_at": "20 08:30"}, {"timestamp": "25 08:00", "ingested_at": "20 08:30"}),
    ]
    for batch in batches:
        append_raw(batch, f"{folder}/log")
        finish(pings.stream_distinct_pings(spark, f"{folder}/log", folder, f"{folder}/c", week))
    counted = pings.read_account(spark, folder).orderBy("batch").drop("newest", "batch")
    assert [tuple(r) for r in counted.collect()] == [(5, 1, 1, 0, 3), (2, 1, 1, 0, 0), (3, 2, 0, 1, 0)]
    assert all(r.arrived == r.kept + r.repeated + r.late + r.unusable for r in counted.collect())
    assert as_set(pings.read_kept(spark, folder).select(F.date_format("timestamp", "dd"), "speed")) == {
        ("10", 1.0), ("20", 10.0), ("14", 10.0), ("25", 10.0)
    }
    assert pings.read_late(spark, folder).count() == 1
    # A batch that is repeated, as after a crash, arrives at the same tables.
    pings.sort_batch(batches[1], 1, folder, week)
    assert [tuple(r) for r in pings.read_account(spark, folder).orderBy("batch").drop("newest", "batch").collect()][1] == (2, 1, 1, 0, 0)
    assert pings.read_kept(spark, folder).count() == 4
    empty = batches[0].limit(0)
    pings.sort_batch(empty, 3, folder, week)
    assert pings.read_account(spark, folder).where("batch = 3 AND arrived = 0 AND kept = 0 AND late = 0").count() == 1


def test_repeated_pings_are_dropped(spark, folder, ping_rows):
    append_raw(ping_rows({}, {}, {"timestamp": "10 08:16"}), f"{folder}/vlog")
    stream = read_log_stream(spark, f"{folder}/vlog", schemas.RAW_VEHICLE_POSITIONS)
    writer = fleet_stream.distinct_pings(stream).writeStream.option("checkpointLocation", f"{folder}/c")
    finish(writer.format("parquet").trigger(availableNow=True).start(f"{folder}/out"))
    assert spark.read.parquet(f"{folder}/out").count() == 2


def test_windows_over_unrevised_events(spark, folder, source):
    events = int_trip_stop_events_deduped(stg_trip_updates(event_stream.raw_trip_updates(source)))
    events.write.parquet(f"{folder}/events")
    everything = as_set(delays.int_route_delay_hourly(events))
    for n, (files, per_batch) in enumerate(((1, 1), (6, 2))):
        # Files that hold events of all times, as a late or unordered feed would.
        events.repartition(files, F.xxhash64("event_key")).write.parquet(f"{folder}/part{n}")
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", per_batch)
        finish(route_metrics.stream_delay_counts(stream.parquet(f"{folder}/part{n}"), f"{folder}/n{n}", f"{folder}/c{n}"))
        assert as_set(hourly_windows(spark, f"{folder}/n{n}")) == everything


MESSAGE = (
    '{"header":{"timestamp":1704874740},"entity":[{"id":"e1","trip_update":{"trip":{"trip_id":"t1","route_id":"r1",'
    '"start_date":"20240110","start_time":"08:00:00","schedule_relationship":0},"stop_time_update":[{"stop_id":"s1",'
    '"stop_sequence":1,"arrival":{"time":1704875400,"delay":60},"departure":{"time":1704875460,"delay":90}}]}}]}'
)


def feed_of(spark, folder, name, *lines, **options):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(f"{folder}/{name}")
    return read_feed(spark, f"{folder}/{name}", schemas.TRIP_FEED, **options)


def test_broken_feeds_stop_the_job(spark, folder):
    cut_off = feed_of(spark, folder, "cut", MESSAGE, MESSAGE[:-20])
    indented = feed_of(spark, folder, "indented", *json.dumps(json.loads(MESSAGE), indent=1).split("\n"))
    unknown = feed_of(spark, folder, "unknown", MESSAGE.replace('"schedule_relationship":0', '"schedule_relationship":"LATE"'))
    for feed in (cut_off, indented, unknown):
        with pytest.raises(Exception, match="MALFORMED|CAST_INVALID_INPUT|FAILED_READ_FILE"):
            flatten_trip_updates(feed).collect()


def test_numbers_and_names_as_text(spark, folder):
    plain = as_set(without_batch_time(flatten_trip_updates(feed_of(spark, folder, "plain", MESSAGE))))
    quoted = re.sub(r":(\d+)", r':"\1"', MESSAGE.replace("08:00:00", "@")).replace("@", "08:00:00")
    assert as_set(without_batch_time(flatten_trip_updates(feed_of(spark, folder, "quoted", quoted)))) == plain
    indented = feed_of(spark, folder, "lines", *json.dumps(json.loads(MESSAGE), indent=1).split("\n"), multiLine=True)
    assert as_set(without_batch_time(flatten_trip_updates(indented))) == plain
    cancelled = MESSAGE.replace('"schedule_relationship":0', '"schedule_relationship":"CANCELED"')
    rows = flatten_trip_updates(feed_of(spark, folder, "named", cancelled)).collect()
    assert [r.schedule_relationship for r in rows] == ["3", "3"]


def test_rejects_are_set_aside(spark, folder):
    feed_of(spark, folder, "some", MESSAGE, MESSAGE[:-9], "{}", MESSAGE.replace("1704875400", '"noon"'))
    good, bad = split_feed(spark, f"{folder}/some", schemas.TRIP_FEED)
    assert flatten_trip_updates(good).count() == 2
    assert sorted(r.reason for r in bad.collect()) == ["no message", "not a number", "unreadable"]


def test_stream_stops_at_a_broken_feed(spark, folder):
    feed_of(spark, folder, "streamed", MESSAGE, MESSAGE[:-20])
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        stream_trip_feed(spark, f"{folder}/streamed", f"{folder}/log", f"{folder}/c").awaitTermination()


def test_a_repeated_load_replaces_itself(spark, folder, trip_rows):
    rows = trip_rows({}, {"stop_id": "s2"})
    assert append_raw(rows, f"{folder}/log", "one") == append_raw(rows, f"{folder}/log", "one") == 2
    append_raw(rows, f"{folder}/log")
    assert read_raw(spark, f"{folder}/log", schemas.RAW_TRIP_UPDATES).count() == 4
