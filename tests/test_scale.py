"""Shapes of plans, hot keys and the session zone."""

from __future__ import annotations

import os
import re
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from conftest import AS_OF, SF_SMALL, as_set
from headway import schemas
from headway.functions import utc_literal
from headway.llm import components, near_dedup
from headway.plans import delays, fleet, sketches
from headway.plans.events import int_trip_stop_events_deduped
from headway.plans.staging import stg_trip_updates, stg_vehicle_positions
from headway.sources import event_stream, feeds
from headway.sources.raw_log import append_raw, read_raw
from headway.sources.scratch import new_folder, passing_folders, shared_folder, written


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def source(spark):
    return event_stream.read_events(spark, SF_SMALL)


@pytest.fixture(scope="module")
def hot(spark):
    """Events of which a third fall on one user and one poll hour."""
    events = event_stream.read_events(spark, SF_SMALL)
    return events.withColumns(
        {
            "user_id": F.when(F.col("event_id") % 3 == 0, F.lit(5)).otherwise(F.col("user_id")),
            "ts": F.when(
                F.col("event_id") % 3 == 0,
                F.timestamp_add("MILLISECOND", F.col("event_id"), utc_literal("2024-01-09 10:00:00")),
            ).otherwise(F.col("ts")),
        }
    )


def test_newest_per_key_is_limited_before_the_shuffle(source):
    lines = plan(stg_trip_updates(event_stream.raw_trip_updates(source)))
    assert re.search(r"WindowGroupLimit.*Final[\s\S]*Exchange hashpartitioning[\s\S]*WindowGroupLimit.*Partial", lines)
    assert lines.count("Exchange") == 1


def test_scan_reads_only_needed_columns(source):
    lines = plan(delays.int_route_delay_hourly(int_trip_stop_events_deduped(stg_trip_updates(event_stream.raw_trip_updates(source)))))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in lines


def test_daily_computes_no_percentiles(source):
    lines = plan(delays.fct_route_delay_daily(delays.int_route_delay_hourly(int_trip_stop_events_deduped(stg_trip_updates(event_stream.raw_trip_updates(source))))))
    assert lines.count("Window [") == 1  # the newest-per-key step only


def test_mark_prunes_partitions_and_row_groups(spark, source):
    folder = new_folder(spark, "plan")
    append_raw(event_stream.raw_trip_updates(source), folder)
    fresh = read_raw(spark, folder, schemas.RAW_TRIP_UPDATES, ingested_after="2024-01-20 10:00:00")
    lines = plan(stg_trip_updates(fresh))
    assert re.search(r"PartitionFilters: \[isnotnull\(ingest_date.*ingest_date#\d+ >= 2024-01-20", lines)
    assert re.search(r"PushedFilters: .*GreaterThan\(ingested_at,2024-01-20T10:00\)", lines)
    everything = read_raw(spark, folder, schemas.RAW_TRIP_UPDATES)
    assert as_set(fresh) == as_set(everything.where(F.col("ingested_at") > utc_literal("2024-01-20 10:00:00")))


@pytest.mark.parametrize("name", [n for n in registry.transit_queries() if not n.startswith("stream_") and n not in ("dq_results", "incremental_upsert")])
def test_no_query_needs_python_or_a_cross_join(spark, name):
    lines = plan(registry.transit_queries()[name](spark, SF_SMALL))
    for banned in ("Cartesian", "NestedLoop", "Python", "Pandas", "SinglePartition, REPARTITION"):
        assert banned not in lines


def test_hot_keys(hot):
    raw = event_stream.raw_trip_updates(hot)
    newest = {}
    for r in raw.collect():
        route, kind = r.route_id.strip(), r.event_type.strip().upper()
        if r.event_time is None or not route or kind == "SKIPPED":
            continue
        rank = (r.ingested_at, r.feed_timestamp, r.event_time, r.entity_id)
        key = (r.trip_id.strip(), r.stop_id or "", kind)
        if key not in newest or rank > newest[key][0]:
            newest[key] = (rank, (route, r.event_time, r.delay_sec))
    staged = stg_trip_updates(raw)
    assert as_set(staged, "route_id", "event_time", "delay_sec") == {row for _, row in newest.values()}


def test_hot_hour_percentiles(spark):
    hours = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 50)).alias("route_id"),
        utc_literal("2024-01-01 08:00:00").alias("event_hour"),
        (F.xxhash64("id") % 2000).cast("int").alias("delay_sec"),
    )
    groups: dict[str, list[int]] = {}
    for r in hours.collect():
        groups.setdefault(r.route_id, []).append(r.delay_sec)
    expected = set()
    for route, values in groups.items():
        values.sort()
        n = len(values)
        late = sum(v >= 300 for v in values)
        expected.add((route, n, sum(values) / n, values[-(-n * 50 // 100) - 1], values[-(-n * 90 // 100) - 1], late, late / n))
    columns = ["route_id", "num_events", "avg_delay_sec", "p50_delay_sec", "p90_delay_sec", "delayed_5m_events", "pct_events_delayed_5m"]
    assert as_set(delays.int_route_delay_hourly(hours), *columns) == expected


def test_vehicles_without_trip_are_spread(spark, ping_rows, trip_rows):
    pings = ping_rows(*({"vehicle_id": f"v{i}", "trip_id": " " if i % 3 else "t1"} for i in range(60)))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        live = fleet.fct_latest_vehicle_positions(stg_vehicle_positions(pings), stg_trip_updates(trip_rows({})), AS_OF)
        assert "SortMergeJoin" in plan(live)
        assert {(r.trip_id, r.current_delay_sec) for r in live.collect()} == {(None, 0), ("t1", 100)}
        assert live.count() == 60
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_trip_with_many_vehicles_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    trip = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 500))
    pings = spark.range(0, 30000, 1, 8).select(
        F.concat(F.lit("v"), "id").alias("vehicle_id"),
        trip.alias("trip_id"),
        F.lit("r").alias("route_id"),
        *(F.lit(1.0).alias(c) for c in ("position_lat", "position_lon", "bearing", "speed")),
        utc_literal("2024-01-10 00:00:00").alias("timestamp"),
    )
    staged = spark.range(500).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("trip_id"),
        F.col("id").cast("int").alias("delay_sec"),
        *(utc_literal("2024-01-10 00:00:00").alias(c) for c in ("ingested_at", "feed_timestamp", "event_time")),
        F.col("id").cast("string").alias("event_key"),
    )
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        live = fleet.fct_latest_vehicle_positions(pings, staged, AS_OF)
        rows = live.collect()
        assert "skew=true" in live._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(rows) == 30000
    for r in rows:
        expected = 0 if r.trip_id in ("hot", "t0") else int(r.trip_id[1:])
        assert r.current_delay_sec == expected


@pytest.mark.parametrize("zone", ["America/New_York", "Australia/Lord_Howe"])
def test_results_do_not_depend_on_the_session_zone(spark, trip_rows, ping_rows, zone):
    hours = [f"10 {h:02d}:59" for h in range(24)]
    # Clocks change on 10 March 2024 in New York and on 7 April on Lord Howe Island.
    moved = {
        c: F.timestamp_add("DAY", F.lit(d), F.col(c)) for c, d in (("event_time", 60), ("ingested_at", 60), ("feed_timestamp", 60))
    }
    raw = trip_rows(*({"stop_id": str(i), "event_time": h} for i, h in enumerate(hours))).withColumns(moved)
    april = raw.withColumns({c: F.timestamp_add("DAY", F.lit(28), F.col(c)) for c in moved}).withColumn("trip_id", F.lit("t2"))
    raw = raw.unionByName(april)
    pings = ping_rows({}).withColumn("timestamp", utc_literal("2024-03-10 02:30:00"))

    def results():
        staged = stg_trip_updates(raw)
        hourly = delays.int_route_delay_hourly(int_trip_stop_events_deduped(staged))
        live = fleet.fct_latest_vehicle_positions(stg_vehicle_positions(pings), staged, "2024-03-10 12:00:00")
        return as_set(staged), as_set(hourly), as_set(delays.fct_route_delay_daily(hourly)), as_set(live)

    expected = results()
    assert {(r[1].day, r[1].hour) for r in expected[1]} == {(d, h) for d in (10, 7) for h in range(24)}
    assert {r[8] for r in expected[3]} == {570}
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert results() == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hot_date_is_written_by_several_tasks(spark):
    rows = spark.range(0, 200000, 1, 8).select(
        F.timestamp_add("DAY", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 20), utc_literal("2024-01-01 00:00:00")).alias("ingested_at"),
        F.md5(F.col("id").cast("string")).alias("text"),
    )
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500k")
    try:
        folder = new_folder(spark, "hot")
        assert append_raw(rows, folder) == 200000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = spark.read.parquet(folder).inputFiles()
    hot = [f for f in files if "ingest_date=2024-01-01" in f]
    assert len(hot) > 3
    assert spark.read.parquet(folder).count() == 200000


def test_upsert_joins_by_key(spark):
    from headway.operators.upsert import replace_matching

    rows = spark.range(100).select(F.col("id").cast("string").alias("k"), F.col("id").alias("x"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = replace_matching(rows, rows.where("x < 10").withColumn("x", F.lit(-1).cast("bigint")), "k")
        assert "SortMergeJoin" in plan(merged) and "NestedLoop" not in plan(merged)
        assert merged.agg(F.count("*"), F.sum("x")).first() == (100, sum(range(10, 100)) - 10)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_scratch_folder_comes_from_the_session(spark):
    assert new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_no_local_checkpoint_in_the_package():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for folder, _, files in os.walk(os.path.join(root, "headway")):
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as f:
                    assert "localCheckpoint" not in f.read()


def test_sketches_keep_their_bound_at_any_size(spark):
    """A hot route with far more events than a sketch holds, dealt over many hours and tasks."""
    delays_of = F.pmod(F.xxhash64("id"), F.lit(9000)).cast("int")
    hour = F.timestamp_add("HOUR", (F.col("id") % 40).cast("int"), utc_literal("2024-01-08 00:00:00"))
    events = spark.range(0, 600_000, 1, 16).select(
        F.when(F.col("id") % 50 == 0, "small").otherwise("hot").alias("route_id"), hour.alias("event_hour"), delays_of.alias("delay_sec")
    )
    found = sketches.delay_percentiles(sketches.hourly_sketches(events), "week").collect()
    assert {r.route_id: r.num_events for r in found} == {"hot": 588_000, "small": 12_000}
    for r in found:
        own = events.where(F.col("route_id") == r.route_id)
        for share, value in ((0.5, r.p50_delay_sec), (0.9, r.p90_delay_sec)):
            counts = own.agg(F.count_if(F.col("delay_sec") < value).alias("below"), F.count_if(F.col("delay_sec") <= value).alias("up_to")).first()
            low, high = counts.below / r.num_events, counts.up_to / r.num_events
            assert low - sketches.RANK_ERROR <= share <= high + sketches.RANK_ERROR
    few = events.where(F.col("id") < 4000)
    exact = few.groupBy("route_id").agg(F.expr("percentile_disc(0.9) WITHIN GROUP (ORDER BY delay_sec)").cast("int").alias("p90_delay_sec"))
    assert as_set(sketches.delay_percentiles(sketches.hourly_sketches(few), "week"), "route_id", "p90_delay_sec") == as_set(exact)
    assert sketches.delay_percentiles(sketches.hourly_sketches(events.limit(0))).count() == 0


def _shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, kept = _shuffle_files(spark), spark.conf.get(setting)
    counts = written(spark.range(0, 5000, 1, 4).groupBy((F.col("id") % 700).alias("k")).count(), new_folder(spark, "counts"))
    assert counts.count() == 700 and spark.conf.get(setting) == kept
    counted = _shuffle_files(spark) - before  # those of count() itself may stay
    until = time.time() + 20
    while len(counted) > 8 and time.time() < until:
        time.sleep(0.2)
        counted = _shuffle_files(spark) - before
    assert len(counted) <= 8


def test_passing_folders_go_at_the_end(spark):
    kept = new_folder(spark, "kept")
    with passing_folders(spark):
        first = written(spark.range(3), new_folder(spark, "first"))
        with passing_folders(spark):
            written(first, new_folder(spark, "second"))
        found = written(first, kept)
    left = set(os.listdir(shared_folder(spark)))
    assert os.path.basename(kept) in left and not {n for n in left if n.startswith(("first-", "second-"))}
    assert found.count() == 3


def test_near_duplicates_keep_only_what_the_result_reads(spark):
    prose = [" ".join(f"w{(i * k) % 101}" for i in range(120)) for k in range(2, 9)]
    docs = spark.createDataFrame([(i, prose[i % 7] + f" x{i % 3}") for i in range(60)], "doc_id bigint, text string")
    before = set(os.listdir(shared_folder(spark)))
    assert near_dedup.near_duplicates(docs).where("kept").count() == 7
    left = sorted(n.rsplit("-", 1)[0] for n in set(os.listdir(shared_folder(spark))) - before)
    assert left == ["labels", "named", "sketches"]


def test_near_duplicates_broadcast_no_table(spark, monkeypatch):
    """Files and lists are far larger in memory than the planner takes them for; the driver would hold them."""
    plans = []

    def planned(df, path):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, path)

    monkeypatch.setattr(near_dedup, "written", planned)
    monkeypatch.setattr(components, "written", planned)
    shared = [f"s{i}" for i in range(60)]
    texts = [" ".join([*shared, *(f"t{k}x{i}" for i in range(16))]) for k in range(40)]
    texts += [" ".join(f"c{(7 * i) % 90}" for i in range(120)) + f" e{k}" for k in range(20)]
    docs = spark.createDataFrame([*enumerate(texts), (3, texts[0]), (3, texts[0])], "doc_id bigint, text string")
    options = near_dedup.Options(shingle=2)
    for found in (near_dedup.near_duplicates(docs, options=options), near_dedup.keep_one_of_each(docs, options=options)):
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        assert found.count() >= 41
    joins = [line for plan in plans for line in plan.splitlines() if "Join" in line]
    assert len(joins) > 40 and not [line for line in joins if "Broadcast" in line]


def test_typing_a_feed_names_every_value_once(spark, tmp_path):
    """One pass over the entities; the look-up of a name does not double with every name."""
    (tmp_path / "feed.json").write_text('{"header": {"timestamp": 1}, "entity": []}\n')
    for schema, flatten, enum in (
        (schemas.TRIP_FEED, feeds.flatten_trip_updates, "schedule_relationship"),
        (schemas.VEHICLE_FEED, feeds.flatten_vehicle_positions, "current_status"),
    ):
        rows = flatten(feeds.read_feed(spark, str(tmp_path), schema))
        text = rows._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("transform(entity#") == 1
        assert len(re.findall(rf"lambda x_\d+#\d+\.[a-z_.]*{enum}", text)) <= 2
