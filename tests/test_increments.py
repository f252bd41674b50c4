"""Incremental loads against the rule applied row by row in plain Python."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, as_set, moment
from headway import schemas
from headway.functions import utc_literal
from headway.operators import upsert as operator
from headway.operators.upsert import upsert
from headway.plans import increments
from headway.plans.delays import fct_route_delay_daily, fct_route_delay_hourly, int_route_delay_hourly
from headway.plans.events import int_trip_stop_events_deduped
from headway.plans.pipeline import Project
from headway.plans.staging import stg_trip_updates, stg_vehicle_positions
from headway.sources import event_stream
from headway.sources.raw_log import append_raw, read_raw
from headway.sources.scratch import new_folder, written
from headway.sources.table import StoredTable, by_hash


@pytest.fixture
def folder(spark):
    return new_folder(spark, "test")


@pytest.fixture
def events(spark, folder):
    return increments.events_table(spark, folder)


def load(events, folder, raw):
    append_raw(raw, f"{folder}/log")
    return increments.load_new_events(events, f"{folder}/log")


def test_row_whose_newest_turns_null_stays(events, folder, trip_rows):
    load(events, folder, trip_rows({}))
    load(events, folder, trip_rows({"ingested_at": "10 08:40", "delay_sec": None}))
    assert as_set(events.read(), "delay_sec") == {(100,)}


def test_rows_at_the_mark_are_not_loaded(events, folder, trip_rows):
    load(events, folder, trip_rows({}))
    assert events.mark == "2024-01-10 08:20:00"
    assert load(events, folder, trip_rows({"stop_id": "late"})) == []
    assert events.read().count() == 1
    load(events, folder, trip_rows({"stop_id": "s9", "ingested_at": "10 08:21"}))
    assert as_set(events.read(), "stop_id") == {("s1",), ("s9",)}


def test_empty_target_loads_everything(events, folder, trip_rows):
    load(events, folder, trip_rows({"delay_sec": None}))
    assert (events.read().count(), events.mark) == (0, None)
    load(events, folder, trip_rows({"stop_id": "s2"}))
    assert as_set(events.read(), "stop_id") == {("s2",)}


def test_staging_reads_the_newest_batch_again(spark, folder, trip_rows, ping_rows):
    updates = increments.staged_updates_table(spark, folder)
    append_raw(trip_rows({}), f"{folder}/log")
    increments.stage_new_updates(updates, f"{folder}/log")
    append_raw(trip_rows({"stop_id": "late"}, {"entity_id": "e2", "delay_sec": 7}), f"{folder}/log")
    increments.stage_new_updates(updates, f"{folder}/log")
    assert as_set(updates.read(), "stop_id", "entity_id", "delay_sec") == {("late", "e1", 100), ("s1", "e2", 7)}
    pings = increments.staged_pings_table(spark, folder)
    append_raw(ping_rows({}, {"vehicle_id": " "}), f"{folder}/vlog")
    increments.stage_new_pings(pings, f"{folder}/vlog")
    append_raw(ping_rows({"vehicle_id": "", "entity_id": "e2"}, {"ingested_at": "10 08:40", "speed": 1.0}), f"{folder}/vlog")
    increments.stage_new_pings(pings, f"{folder}/vlog")
    assert as_set(pings.read(), "vehicle_id", "entity_id", "speed") == {("v1", "e1", 1.0), (None, "e2", 10.0)}
    increments.stage_new_pings(pings, f"{folder}/vlog", rebuild=True)
    assert pings.read().count() == 2


def test_blank_vehicle_moves_between_days(spark, folder, ping_rows):
    pings = increments.staged_pings_table(spark, folder)
    batches = [
        [{"vehicle_id": " "}, {}],
        [{"vehicle_id": " ", "timestamp": "12 01:00", "ingested_at": "12 01:20"}],
        [{"timestamp": "12 02:00", "ingested_at": "12 02:20"}, {"ingested_at": "12 02:20", "speed": 3.0}],
        [{"vehicle_id": "", "timestamp": "11 01:00", "ingested_at": "12 03:20"}],
    ]
    changed = [increments.stage_pings(pings, ping_rows(*batch)) for batch in batches]
    assert changed[1:] == [["blank"], ["2024-01-10", "2024-01-12"], ["blank"]]
    whole = ping_rows(*(row for batch in batches for row in batch))
    assert as_set(pings.read()) == as_set(stg_vehicle_positions(whole))
    assert pings.read().count() == 3


def derived(spark, folder):
    makers = (increments.counts_table, increments.hourly_table, increments.daily_table)
    return [make(spark, folder) for make in makers]


def test_event_moving_to_another_day_leaves_no_trace(spark, events, folder, trip_rows):
    counts, hourly, daily = derived(spark, folder)
    load(events, folder, trip_rows({}, {"stop_id": "s2", "event_time": "12 10:00"}))
    assert increments.refresh_metrics(events, counts, hourly, daily) is None
    load(events, folder, trip_rows({"ingested_at": "10 08:40", "event_time": "11 00:05", "delay_sec": 7}))
    assert increments.refresh_metrics(events, counts, hourly, daily) == ["2024-01-10", "2024-01-11"]
    assert as_set(events.read(), "stop_id", "event_date") == {
        ("s1", dt.date(2024, 1, 11)),
        ("s2", dt.date(2024, 1, 12)),
    }
    for table, count in ((daily, "total_events"), (hourly, "num_events"), (counts, "n")):
        assert as_set(table.read(), "date_day", count) == {(dt.date(2024, 1, 11), 1), (dt.date(2024, 1, 12), 1)}
        assert sorted(table.pointer().parts) == ["2024-01-11", "2024-01-12"]
    assert increments.refresh_metrics(events, counts, hourly, daily) == []


def test_refresh_reads_no_event(spark, events, folder, trip_rows, monkeypatch):
    tables = derived(spark, folder)
    load(events, folder, trip_rows({}, {"stop_id": "s2"}, {"stop_id": "s3", "event_time": "12 10:00"}))
    increments.refresh_metrics(events, *tables)
    load(events, folder, trip_rows({"ingested_at": "10 08:40", "delay_sec": 900}))
    change = increments.behind(events.pointer(), tables[0])
    after = increments.with_deltas(events, tables[0], change.folders, change.days)
    read = [f.split("/data/")[0].rsplit("/", 1)[1] + "/" + f.split("/data/")[1][0] for f in after.inputFiles()]
    assert set(read) == {"route_delay_counts/v", "int_trip_stop_events_deduped/d"}
    assert all("part=2024-01-10" in f for f in after.inputFiles())
    monkeypatch.setattr(events, "read", None)
    assert increments.refresh_metrics(events, *tables) == ["2024-01-10"]
    expected = {("10", 100, 1), ("10", 900, 1), ("12", 100, 1)}
    assert as_set(tables[0].read().withColumn("day", F.date_format("date_day", "dd")), "day", "delay_sec", "n") == expected


def test_revision_within_an_hour_that_changes_nothing(spark, events, folder, trip_rows):
    tables = derived(spark, folder)
    load(events, folder, trip_rows({}))
    increments.refresh_metrics(events, *tables)
    load(events, folder, trip_rows({"ingested_at": "10 08:40"}))
    assert events.pointer().notes["deltas"][-1][2] == []
    assert increments.refresh_metrics(events, *tables) == []
    assert as_set(tables[0].read(), "delay_sec", "n") == {(100, 1)}


@pytest.mark.parametrize("lost_at", [0, 1, 2])
def test_metrics_catch_up_after_a_lost_refresh(spark, events, folder, trip_rows, monkeypatch, lost_at):
    tables = derived(spark, folder)
    load(events, folder, trip_rows({}, {"stop_id": "s2"}))
    increments.refresh_metrics(events, *tables)
    for minute, hour in ((40, "01:00"), (50, "02:00")):
        moved = trip_rows({"ingested_at": f"10 08:{minute}", "event_time": f"11 {hour}", "delay_sec": minute})
        load(events, folder, moved)
        increments.apply_raw(events, moved)  # the batch again, as after a crash before the refresh

        def lost(*_, **__):
            raise RuntimeError("driver lost")

        with monkeypatch.context() as patched:
            patched.setattr(tables[lost_at], "replace", lost)
            with pytest.raises(RuntimeError, match="driver lost"):
                increments.refresh_metrics(events, *tables)
    increments.refresh_metrics(events, *tables)
    expected = fct_route_delay_hourly(int_route_delay_hourly(events.read()))
    assert as_set(tables[1].read()) == as_set(expected)
    assert as_set(tables[2].read(), "date_day", "total_events") == {
        (dt.date(2024, 1, 10), 1), (dt.date(2024, 1, 11), 1)
    }


def test_metrics_far_behind_start_again(spark, events, folder, trip_rows, monkeypatch):
    monkeypatch.setattr(increments, "KEPT_DELTAS", 2)
    tables = derived(spark, folder)
    load(events, folder, trip_rows({}))
    increments.refresh_metrics(events, *tables)
    for minute in (30, 40, 50):
        load(events, folder, trip_rows({"ingested_at": f"10 08:{minute}", "delay_sec": minute}))
    assert increments.refresh_metrics(events, *tables) is None
    assert as_set(tables[0].read(), "delay_sec", "n") == {(50, 1)}


def test_only_the_buckets_of_the_increment_are_read_and_written(spark, folder, trip_rows, monkeypatch):
    events = increments.events_table(spark, folder, buckets=16)
    load(events, folder, trip_rows(*({"stop_id": f"s{i}"} for i in range(200))))
    before = events.pointer()
    assert len(before.parts) == 16
    read = []
    plain = StoredTable.read

    def noted(self, parts=None, *args):
        read.append((self.path, parts))
        return plain(self, parts, *args)

    monkeypatch.setattr(StoredTable, "read", noted)
    touched = load(events, folder, trip_rows({"ingested_at": "10 08:40", "stop_id": "s7", "delay_sec": 1}))
    assert len(touched) == 1 and read == [(events.path, touched)] * 2
    after = events.pointer()
    assert [p for p in before.parts if before.parts[p] != after.parts[p]] == touched
    assert plain(events).count() == 200
    files = plain(events, touched).inputFiles()
    assert files and all(f"part={touched[0]}/" in f for f in files)


def test_failed_write_leaves_the_table_as_it_was(spark, events, folder, trip_rows):
    load(events, folder, trip_rows({}))
    before = as_set(events.read())
    events.write_parts(events.read(with_hidden=True).withColumn("delay_sec", F.lit(-1)), "v=2-lost")  # data without its pointer
    assert as_set(events.read()) == before
    load(events, folder, trip_rows({"stop_id": "s2", "ingested_at": "10 08:40"}))
    assert events.read().count() == 2


def test_repeating_and_reordering_batches(spark, folder, trip_rows):
    batches = [
        trip_rows({}, {"stop_id": "s2"}),
        trip_rows({"ingested_at": "10 08:40", "delay_sec": 2, "event_time": "11 01:00"}),
        trip_rows({"ingested_at": "10 09:00", "delay_sec": 3}, {"stop_id": "s3", "ingested_at": "10 09:00"}),
    ]
    results = []
    for n, order in enumerate([(0, 1, 2), (0, 0, 1, 1, 2, 2), (2, 1, 0), (1, 2, 0, 1)]):
        table = increments.events_table(spark, f"{folder}/{n}")
        for i in order:
            increments.apply_raw(table, batches[i])
        results.append(as_set(table.read()))
    assert all(r == results[0] for r in results)
    assert len(results[0]) == 3


def test_null_key_is_one_key(spark, folder):
    schema = "k string, day date, ingested_at timestamp_ntz, x int"
    table = StoredTable(spark, f"{folder}/t", schema, by_hash("k", 4))

    def rows(*values):
        return spark.createDataFrame(list(values), schemas.struct(table.schema))

    first, second = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    upsert(table, rows((None, first, moment("01 00:00"), 1), ("a", first, moment("01 00:00"), 1)), "k", ["ingested_at"])
    upsert(table, rows((None, second, moment("02 00:00"), 2)), "k", ["ingested_at"])
    assert as_set(table.read(), "k", "day", "x") == {(None, second, 2), ("a", first, 1)}


def test_one_pass_brings_up_staged_rows_and_events(spark, folder, trip_rows, monkeypatch):
    """A project reads the trip log once a run; both tables hold what their own increments make of
    it, also where their marks differ and a row arrives late."""
    log = f"{folder}/log"
    read = []
    plain = increments.read_raw
    monkeypatch.setattr(increments, "read_raw", lambda *a, **k: read.append(a) or plain(*a, **k))
    project = Project(spark, log, f"{folder}/pings", f"{folder}/warehouse")
    names = {increments.STAGED_UPDATES, increments.EVENTS}
    alone = increments.staged_updates_table(spark, f"{folder}/alone"), increments.events_table(spark, f"{folder}/alone")
    batches = [
        ({}, {"stop_id": "s2"}, {"stop_id": "s3"}),
        ({"ingested_at": "10 08:40", "delay_sec": None}, {"stop_id": "s3", "ingested_at": "10 08:40", "delay_sec": 99999}),
        ({"ingested_at": "10 08:30", "stop_id": "s4"}, {"ingested_at": "10 08:40", "entity_id": "e0", "delay_sec": 5}),
        ({"ingested_at": "10 09:00", "delay_sec": 7}, {"stop_id": "s5", "ingested_at": "10 09:00"}),
    ]
    for batch in batches:
        append_raw(trip_rows(*batch), log)
        read.clear()
        project._bring_up_to_date(names, False)
        assert len(read) == 1
        increments.stage_new_updates(alone[0], log)
        increments.load_new_events(alone[1], log)
        for table in alone:
            ours = project.kept[table.path.rpartition("/")[2]]
            assert as_set(ours.read(with_hidden=True)) == as_set(table.read(with_hidden=True))
            assert ours.mark == table.mark
    staged, held = (as_set(project.kept[name].read(), "stop_id") for name in (increments.STAGED_UPDATES, increments.EVENTS))
    assert staged == {("s1",), ("s2",), ("s3",), ("s5",)} and held == staged | {("s4",)}
    counts, hourly, daily = derived(spark, folder)
    increments.refresh_metrics(project.kept[increments.EVENTS], counts, hourly, daily)
    assert as_set(hourly.read(), "num_events") == {(5,)}


def test_rows_newer_than_the_mark_are_not_compared(spark, folder, monkeypatch):
    schema = "k string, ingested_at timestamp_ntz, x int"
    table = StoredTable(spark, f"{folder}/t", schema, by_hash("k", 4))
    kept = []
    monkeypatch.setattr(operator, "written", lambda df, path: kept.append(path.rpartition("/")[2]) or written(df, path))

    def merge(*values):
        kept.clear()
        upsert(table, spark.createDataFrame([(k, moment(at), x) for k, at, x in values], schemas.struct(schema)), "k", ["ingested_at"])
        return as_set(table.read(), "k", "x")

    merge(("a", "01 00:00", 1), ("b", "01 00:00", 2), (None, "01 00:00", 3))
    assert merge(("a", "02 00:00", 4), ("c", "02 00:00", 5), (None, "02 00:00", 6)) == {("a", 4), ("b", 2), ("c", 5), (None, 6)}
    assert kept == ["delta"]
    older = ("a", "01 12:00", 7), ("b", "01 12:00", 8), ("c", "02 00:00", 9), (None, None, 11), ("e", None, 12)
    mixed = merge(*older, ("d", "03 00:00", 10))
    assert mixed == {("a", 4), ("b", 8), ("c", 9), ("d", 10), ("e", 12), (None, 6)}
    assert table.mark == "2024-01-03 00:00:00"


def test_old_versions_can_be_dropped(spark, events, folder, trip_rows):
    tables = derived(spark, folder)
    for minute in (20, 30, 40, 50):
        load(events, folder, trip_rows({"ingested_at": f"10 08:{minute}", "delay_sec": minute}))
        increments.refresh_metrics(events, *tables[:1], *tables[1:]) if minute == 20 else None
    before = as_set(events.read())
    events.drop_old(keep=1)
    assert as_set(events.read()) == before and events.versions() == [4]
    folders = events._names(f"{events.path}/data")
    # The signed counts that metrics may still need stay; merged content of old pointers goes.
    assert [f[:3] for f in folders] == ["d=2", "d=3", "d=4", "v=4"]
    assert increments.refresh_metrics(events, *tables) == ["2024-01-10"]
    assert as_set(tables[0].read(), "delay_sec", "n") == {(50, 1)}


def test_second_writer_is_refused(spark, events, folder, trip_rows):
    """Of two writers that start from one pointer the first to finish keeps its rows."""
    load(events, folder, trip_rows({}))
    second = increments.events_table(spark, folder)
    publish = second._publish

    def after_the_first(version, text):
        load(events, folder, trip_rows({"stop_id": "s2", "ingested_at": "10 08:40"}))
        publish(version, text)

    second._publish = after_the_first
    with pytest.raises(RuntimeError, match="another writer"):
        increments.apply_raw(second, trip_rows({"stop_id": "s3", "ingested_at": "10 08:50"}))
    assert as_set(events.read(), "stop_id") == {("s1",), ("s2",)}
    increments.apply_raw(events, trip_rows({"stop_id": "s3", "ingested_at": "10 08:50"}))
    assert events.read().count() == 3


def test_writer_that_read_before_another_finished_is_refused(spark, folder):
    table = StoredTable(spark, f"{folder}/t", "x int")
    rows = spark.createDataFrame([(1,)], "x int")
    at = table.pointer()
    table.replace(rows)
    with pytest.raises(RuntimeError, match="another writer"):
        table.replace(rows, at=at)
    assert table.versions() == [1] and len(table._names(f"{folder}/t/pointers")) == 1


def test_one_poll_over_two_batches(spark, folder, trip_rows):
    """Ties of ingestion and feed time are settled alike in any order and all at once."""
    first = trip_rows({"entity_id": "a", "delay_sec": 111})
    second = trip_rows({"entity_id": "b", "delay_sec": 222})
    results = []
    for n, batches in enumerate([(first, second), (second, first), (first.unionByName(second),)]):
        table = increments.events_table(spark, f"{folder}/tie{n}")
        for batch in batches:
            increments.apply_raw(table, batch)
        results.append(as_set(table.read(), "delay_sec"))
    assert results == [{(222,)}] * 3


def plain_replay(raw_rows, cuts):
    """The rule, slice by slice: newest usable row above the target's newest, merged by key."""
    target = {}
    for upper in cuts:
        mark = max((r["ingested_at"] for r in target.values()), default=None)
        newest = {}
        for r in raw_rows:
            if r["ingested_at"] >= upper or (mark is not None and r["ingested_at"] <= mark):
                continue
            route = (r["route_id"] or "").strip()
            kind = (r["event_type"] or "").strip().upper()
            if r["event_time"] is None or not route or kind not in ("ARRIVAL", "DEPARTURE"):
                continue
            key = f"{(r['trip_id'] or '').strip()}-{(r['stop_id'] or '').strip()}-{kind}"
            rank = (r["ingested_at"], r["feed_timestamp"], r["event_time"], r["entity_id"])
            if key not in newest or rank > newest[key][0]:
                newest[key] = (rank, r)
        for key, (_, r) in newest.items():
            if r["delay_sec"] is not None and -1800 <= r["delay_sec"] <= 14400:
                target[key] = r
    return {(r["event_time"], r["delay_sec"], r["ingested_at"]) for r in target.values()}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_slices_follow_the_rule(spark, events, folder, seed):
    raw = event_stream.raw_trip_updates(event_stream.read_events(spark, SF_SMALL)).cache()
    rng = random.Random(seed)
    days = sorted(rng.sample(range(2, 30), 3))
    cuts = [dt.datetime(2024, 1, d, rng.randrange(24)) for d in days] + [dt.datetime(2025, 1, 1)]
    below = None
    for cut in cuts:
        part = raw.where(raw.ingested_at < utc_literal(cut))
        if below:
            part = part.where(raw.ingested_at >= utc_literal(below))
        load(events, folder, part)
        below = cut
    expected = plain_replay([r.asDict() for r in raw.collect()], cuts)
    assert as_set(events.read(), "event_time", "delay_sec", "ingested_at") == expected
    # Against a rebuild, only keys whose newest row was filtered differ.
    staged = stg_trip_updates(raw)
    rebuilt = int_trip_stop_events_deduped(staged)
    extra = events.read().select("event_key").subtract(rebuilt.select("event_key"))
    unusable = staged.where("delay_sec IS NULL OR delay_sec NOT BETWEEN -1800 AND 14400").select("event_key")
    assert extra.subtract(unusable).count() == 0
    assert rebuilt.select("event_key").subtract(events.read().select("event_key")).count() == 0
    raw.unpersist()




def test_mark_below_the_newest_step_gives_the_same_rows(spark, folder):
    raw = event_stream.raw_trip_updates(event_stream.read_events(spark, SF_SMALL))
    append_raw(raw, f"{folder}/log")
    mark = "2024-01-15 00:00:00"
    pushed = stg_trip_updates(read_raw(spark, f"{folder}/log", schemas.RAW_TRIP_UPDATES, ingested_after=mark))
    plain = stg_trip_updates(raw)
    plain = plain.where(plain.ingested_at > utc_literal(mark))
    assert as_set(pushed) == as_set(plain)


def test_metrics_equal_a_full_computation(spark, events, folder):
    raw = event_stream.raw_trip_updates(event_stream.read_events(spark, SF_SMALL))
    counts, hourly, daily = derived(spark, folder)
    for low, high in ((1, 9), (9, 10), (10, 32)):
        bounds = [dt.datetime(2024, 1, 1) + dt.timedelta(days=d - 1) for d in (low, high)]
        load(events, folder, raw.where((raw.ingested_at >= utc_literal(bounds[0])) & (raw.ingested_at < utc_literal(bounds[1]))))
        increments.refresh_metrics(events, counts, hourly, daily)
    by_hour = int_route_delay_hourly(events.read())
    assert as_set(hourly.read()) == as_set(fct_route_delay_hourly(by_hour))
    assert as_set(daily.read(), "route_id", "date_day", "total_events") == as_set(
        fct_route_delay_daily(by_hour), "route_id", "date_day", "total_events"
    )


def test_raw_log_round_trip(spark, folder, trip_rows):
    rows = trip_rows({}, {"ingested_at": "11 00:00"})
    assert append_raw(rows, f"{folder}/log") == 2
    assert append_raw(rows.limit(0), f"{folder}/log") == 0
    back = read_raw(spark, f"{folder}/log", schemas.RAW_TRIP_UPDATES)
    assert back.schema == schemas.struct(schemas.RAW_TRIP_UPDATES)
    assert as_set(back) == as_set(rows)
    assert [p.split("=")[-1] for p in sorted({f.rsplit("/", 2)[0] for f in back.inputFiles()})] == [
        "2024-01-10",
        "2024-01-11",
    ]
