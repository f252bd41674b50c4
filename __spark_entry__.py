"""Registered queries and their expected results as SQL.

The transit queries read the ``events`` table of the given folder, from which the raw logs are
derived; the text operators read its documents, pages, conversations and embeddings.
"""

from __future__ import annotations

import datetime as dt
import functools
import importlib
import importlib.util
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import oracle
from headway import schemas
from headway.operators.quality import Check, failing_rows, run_checks
from headway.plans import dashboard, delays, dimensions, events, fleet, freshness, increments, sketches, staging
from headway.plans.pipeline import Project
from headway.sources import event_stream, feeds
from headway.sources.ingest import run_ingest
from headway.sources.raw_log import append_raw, read_raw
from headway.sources.scratch import new_folder, written
from headway.streaming.checks import QUARANTINE, StreamChecks
from headway.streaming.feeds import read_log_stream, stream_trip_feed, stream_vehicle_feed
from headway.plans.live import live_fleet
from headway.streaming import pings as ping_stream
from headway.streaming.fleet import (
    FreshnessMonitor,
    noted_freshness,
    stream_positions,
    stream_staged_updates,
    stream_trip_delays,
)
from headway.streaming.route_metrics import hourly_windows, stream_delay_counts, stream_route_metrics

AS_OF = "2024-01-31 00:00:00"
AFTER_MIDNIGHT = "2024-01-30 00:15:00"
CUTOFF = "2024-01-15 00:00:00"
SLICES = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
PING_BATCHES = 3
PING_LATENESS = dt.timedelta(days=10)


class Lineage:
    """The models over one test folder, each built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.source = event_stream.read_events(spark, sf_dir)

    def raw_trip(self) -> DataFrame:
        return event_stream.raw_trip_updates(self.source)

    def raw_vehicle(self) -> DataFrame:
        return event_stream.raw_vehicle_positions(self.source)

    def staged(self) -> DataFrame:
        return staging.stg_trip_updates(self.raw_trip())

    def pings(self) -> DataFrame:
        return staging.stg_vehicle_positions(self.raw_vehicle())

    def events(self) -> DataFrame:
        return events.int_trip_stop_events_deduped(self.staged())

    def hourly(self) -> DataFrame:
        return delays.int_route_delay_hourly(self.events())

    def daily(self) -> DataFrame:
        return delays.fct_route_delay_daily(delays.hourly_totals(self.events()))

    def compare(self) -> DataFrame:
        return delays.fct_route_delay_daily_compare(self.daily())

    def live(self) -> DataFrame:
        return fleet.fct_latest_vehicle_positions(self.pings(), self.staged(), AS_OF)

    def freshness(self) -> DataFrame:
        return freshness.mart_data_freshness(self.staged(), AS_OF)


def _rounded(df: DataFrame) -> DataFrame:
    """Means to six places: the last bits of a sum depend on the order of addition."""
    kept = {"position_lat", "position_lon", "bearing", "speed"}
    return df.select(
        *(
            F.round(f.name, 6).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) and f.name not in kept
            else F.col(f.name)
            for f in df.schema
        )
    )


def _incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load up to the cutoff, then one increment from the raw log on disk."""
    raw = Lineage(spark, sf_dir).raw_trip()
    folder = new_folder(spark, "incremental")
    table = increments.events_table(spark, folder)
    log = f"{folder}/raw_trip_updates"
    append_raw(raw.where(F.col("ingested_at") <= F.lit(CUTOFF).cast("timestamp_ntz")), log)
    increments.load_new_events(table, log)
    append_raw(raw.where(F.col("ingested_at") > F.lit(CUTOFF).cast("timestamp_ntz")), log)
    increments.load_new_events(table, log)
    return table.read()


def _replayed(spark: SparkSession, sf_dir: str) -> str:
    """Lets the metrics stream follow a raw log that grows in three steps."""
    folder = new_folder(spark, "replay")
    for arrived in _arrivals(Lineage(spark, sf_dir).raw_trip(), *SLICES):
        append_raw(arrived, f"{folder}/raw_trip_updates")
        query = stream_route_metrics(spark, f"{folder}/raw_trip_updates", folder, f"{folder}/progress")
        query.awaitTermination()
    return folder


def _arrivals(rows: DataFrame, *cuts: str) -> list[DataFrame]:
    """The rows in consecutive steps by ingestion time."""
    at = F.col("ingested_at")
    bounds = [F.lit(c).cast("timestamp_ntz") for c in cuts]
    lower = [F.lit(True), *(at >= b for b in bounds)]
    upper = [*(at < b for b in bounds), F.lit(True)]
    return [rows.where(low & high) for low, high in zip(lower, upper)]


def _ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed files in two arrivals, flattened and appended by the ingest stream."""
    feed = event_stream.trip_feed(Lineage(spark, sf_dir).source)
    folder = new_folder(spark, "ingest")
    for arrived in _arrivals(feed, CUTOFF):
        arrived.drop("ingested_at").write.mode("append").json(f"{folder}/feed")
        stream_trip_feed(spark, f"{folder}/feed", f"{folder}/log", f"{folder}/progress").awaitTermination()
    # The batch time is that of the run, so it is left out.
    return read_raw(spark, f"{folder}/log", schemas.RAW_TRIP_UPDATES).drop("ingested_at")


def _mixed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw log written by the ingest stream first and by a batch ingest run after it."""
    source = Lineage(spark, sf_dir).source
    folder = new_folder(spark, "mixed")
    first, rest = _arrivals(event_stream.trip_feed(source), CUTOFF)
    first.drop("ingested_at").write.json(f"{folder}/first")
    rest.drop("ingested_at").write.json(f"{folder}/rest")
    event_stream.vehicle_feed(source).drop("ingested_at").write.json(f"{folder}/vehicles")
    stream_trip_feed(spark, f"{folder}/first", f"{folder}/log", f"{folder}/progress").awaitTermination()
    run_ingest(
        feeds.read_feed(spark, f"{folder}/rest", schemas.TRIP_FEED),
        feeds.read_feed(spark, f"{folder}/vehicles", schemas.VEHICLE_FEED),
        f"{folder}/log",
        f"{folder}/pings",
    )
    return read_raw(spark, f"{folder}/log", schemas.RAW_TRIP_UPDATES).drop("ingested_at")


def _vehicles_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle feed files in two arrivals, appended by the stream and read back."""
    feed = event_stream.vehicle_feed(Lineage(spark, sf_dir).source)
    folder = new_folder(spark, "vehicles")
    for arrived in _arrivals(feed, CUTOFF):
        arrived.drop("ingested_at").write.mode("append").json(f"{folder}/feed")
        stream_vehicle_feed(spark, f"{folder}/feed", f"{folder}/log", f"{folder}/progress").awaitTermination()
    return read_raw(spark, f"{folder}/log", schemas.RAW_VEHICLE_POSITIONS).drop("ingested_at")


def _vehicle_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings appended to a log in two loads and read back from a mark on."""
    log = f"{new_folder(spark, 'pings')}/log"
    for arrived in _arrivals(Lineage(spark, sf_dir).raw_vehicle(), SLICES[0]):
        append_raw(arrived, log)
    return read_raw(spark, log, schemas.RAW_VEHICLE_POSITIONS, ingested_from=CUTOFF)


def _feed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which some are cut off, some give numbers or names as text, and some hold
    text that is neither: what becomes of them, counted."""
    feed = event_stream.trip_feed(Lineage(spark, sf_dir).source)
    line = F.to_json(F.struct("header", "entity"))
    kind = F.col("entity")[0]["id"].cast("bigint") % 10
    relation = F.lit('"schedule_relationship":0')
    rows = feed.select(kind.alias("kind"), line.alias("line"))
    damaged = (
        F.when(F.col("kind") == 0, F.expr("left(line, length(line) - 7)"))
        .when(F.col("kind") == 1, F.regexp_replace("line", '"time":([0-9]+)', '"time":"$1"'))
        .when(F.col("kind") == 2, F.replace("line", relation, F.lit('"schedule_relationship":"CANCELED"')))
        .when(F.col("kind") == 3, F.replace("line", relation, F.lit('"schedule_relationship":"SOMETIMES"')))
        .otherwise(F.col("line"))
    )
    folder = new_folder(spark, "rejects")
    rows.select(damaged.alias("value")).write.text(f"{folder}/feed")
    good, bad = feeds.split_feed(spark, f"{folder}/feed", schemas.TRIP_FEED)
    kept = feeds.flatten_trip_updates(good).select(F.concat(F.lit("kept as "), "schedule_relationship").alias("outcome"))
    return kept.unionByName(bad.select(F.col("reason").alias("outcome"))).groupBy("outcome").agg(F.count("*").alias("n"))


def _built(spark: SparkSession, sf_dir: str) -> tuple[Project, dict[str, DataFrame]]:
    """All models built in a warehouse from two arrivals."""
    lineage = Lineage(spark, sf_dir)
    folder = new_folder(spark, "project")
    project = Project(spark, f"{folder}/updates", f"{folder}/pings", f"{folder}/warehouse")
    for updates, pings in zip(_arrivals(lineage.raw_trip(), CUTOFF), _arrivals(lineage.raw_vehicle(), CUTOFF)):
        append_raw(updates, project.trip_log)
        append_raw(pings, project.vehicle_log)
        models = project.build(as_of=AS_OF)
    return project, models


def _project_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live mart of a project whose models of one tag were built again."""
    project, _ = _built(spark, sf_dir)
    return project.build(tags=["bi_layer"], as_of=AS_OF)["fct_latest_vehicle_positions"]


def _project_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of every model a project stores, as text: one kind of value, one way to write it."""

    def text(field: T.StructField) -> Column:
        value = F.col(field.name)
        shown = value.cast("string")
        if isinstance(field.dataType, T.TimestampNTZType):
            shown = F.concat(F.substring(shown, 1, 19), F.lit("."), F.rpad(F.substring(shown, 21, 6), 6, "0"))
        elif isinstance(field.dataType, T.DoubleType):
            shown = value.cast("decimal(18,6)").cast("string")
        return F.coalesce(shown, F.lit("~"))

    _, models = _built(spark, sf_dir)
    rows = [
        df.select(F.lit(name).alias("model"), F.concat_ws("|", *map(text, sorted(df.schema, key=lambda f: f.name))).alias("stored"))
        for name, df in models.items()
    ]
    return functools.reduce(DataFrame.unionByName, rows)


def _freshness_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness at the time of the query, in days, which are the same for a while."""
    alert = freshness.freshness_alert(freshness.mart_data_freshness(Lineage(spark, sf_dir).staged()))
    days = F.floor(F.col("hours_since_last_feed") / 24).alias("days_since_last_feed")
    return alert.select("last_feed_timestamp", days, "is_stale")


def _live_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live mart from the snapshots that two stateful streams keep while both logs grow."""
    lineage = Lineage(spark, sf_dir)
    folder = new_folder(spark, "live")
    logs = zip(_arrivals(lineage.raw_trip(), CUTOFF), _arrivals(lineage.raw_vehicle(), CUTOFF))
    for updates, pings in logs:
        append_raw(updates, f"{folder}/updates")
        append_raw(pings, f"{folder}/pings")
        stream_trip_delays(spark, f"{folder}/updates", folder, f"{folder}/p1").awaitTermination()
        stream_positions(spark, f"{folder}/pings", folder, f"{folder}/p2").awaitTermination()
    return live_fleet(spark, folder, AS_OF)


def _freshness_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness from what the staging stream's listener noted while the log grew."""
    folder = new_folder(spark, "freshness")
    monitor = FreshnessMonitor(spark, folder)
    spark.streams.addListener(monitor)
    try:
        for arrived in _arrivals(Lineage(spark, sf_dir).raw_trip(), CUTOFF):
            append_raw(arrived, f"{folder}/updates")
            query = stream_staged_updates(spark, f"{folder}/updates", folder, f"{folder}/progress")
            query.awaitTermination()
            monitor.wait(query)
    finally:
        spark.streams.removeListener(monitor)
    return noted_freshness(spark, folder, AS_OF)


def _sorted_pings(spark: SparkSession, sf_dir: str) -> str:
    """Pings that arrive in three batches, each with pings of all days, so that old ones are late."""
    folder = new_folder(spark, "sorted")
    pings = Lineage(spark, sf_dir).raw_vehicle()
    for batch in range(PING_BATCHES):
        append_raw(pings.where(F.col("entity_id").cast("bigint") % PING_BATCHES == batch), f"{folder}/log")
        query = ping_stream.stream_distinct_pings(spark, f"{folder}/log", folder, f"{folder}/progress", PING_LATENESS)
        query.awaitTermination()
    return folder


def _stream_checks(spark: SparkSession, sf_dir: str) -> dict[str, StreamChecks]:
    """The checks of both staged feeds over every cleaned row of logs that grow in three steps,
    usable or not and with all copies."""
    lineage = Lineage(spark, sf_dir)
    folder = new_folder(spark, "checked")
    models = {
        "stg_trip_updates": (lineage.raw_trip(), schemas.RAW_TRIP_UPDATES, staging.keyed_updates),
        "stg_vehicle_positions": (lineage.raw_vehicle(), schemas.RAW_VEHICLE_POSITIONS, staging.clean_vehicle_positions),
    }
    found = {}
    for model, (raw, schema, cleaned) in models.items():
        found[model] = StreamChecks(spark, model, f"{folder}/{model}")
        for arrived in _arrivals(raw, *SLICES):
            append_raw(arrived, f"{folder}/{model}_log")
            log = read_log_stream(spark, f"{folder}/{model}_log", schema)
            found[model].start(cleaned(log), f"{folder}/{model}_progress").awaitTermination()
    return found


def _stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates, pings = _stream_checks(spark, sf_dir).values()
    return updates.totals().unionByName(pings.totals())


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stream_checks(spark, sf_dir)["stg_trip_updates"].rows(schemas.MODELS["stg_trip_updates"], QUARANTINE)
    return rows.select("entity_id", "event_key", "trip_id", "route_id", F.concat_ws(", ", "failed").alias("failed"))


def _polled(spark: SparkSession, sf_dir: str, polls, schema: str, flatten) -> DataFrame:
    """Whole polls written as feed files, read back and flattened."""
    folder = new_folder(spark, "polls")
    polls(Lineage(spark, sf_dir).source).write.json(folder)
    # The batch time is that of the run, so it is left out.
    return flatten(feeds.read_feed(spark, folder, schema)).drop("ingested_at")


def _hourly_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of a stream of golden events that come in several batches, in no order of time."""
    folder = new_folder(spark, "windows")
    golden = written(Lineage(spark, sf_dir).events().repartition(6, F.xxhash64("event_key")), f"{folder}/events")
    events = spark.readStream.schema(golden.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/events")
    stream_delay_counts(events, f"{folder}/counts", f"{folder}/progress").awaitTermination()
    return hourly_windows(spark, f"{folder}/counts")


def _delay_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and weeks merged from stored sketches of the hours."""
    folder = new_folder(spark, "sketches")
    hours = written(sketches.hourly_sketches(Lineage(spark, sf_dir).events()), folder)
    return sketches.delay_percentiles(hours, "day").unionByName(sketches.delay_percentiles(hours, "week"))


def _dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks over built models: what several of them read is written once."""
    lineage = Lineage(spark, sf_dir)
    folder = new_folder(spark, "checks")
    staged = written(lineage.staged(), f"{folder}/staged")
    golden = written(events.int_trip_stop_events_deduped(staged), f"{folder}/events")
    hourly = written(delays.int_route_delay_hourly(golden), f"{folder}/hourly")
    pings = written(lineage.pings(), f"{folder}/pings")
    daily = delays.fct_route_delay_daily(hourly)
    return run_checks(
        {
            "stg_trip_updates": staged,
            "stg_vehicle_positions": pings,
            "int_trip_stop_events_deduped": golden,
            "int_route_delay_hourly": hourly,
            "dim_route": dimensions.dim_route(golden),
            "dim_date": dimensions.dim_date(golden),
            "fct_route_delay_hourly": delays.fct_route_delay_hourly(hourly),
            "fct_route_delay_daily": daily,
            "fct_route_delay_daily_compare": delays.fct_route_delay_daily_compare(daily),
            "fct_latest_vehicle_positions": fleet.fct_latest_vehicle_positions(pings, staged, AS_OF),
        }
    )


def entry(spark: SparkSession) -> DataFrame:
    """Daily route delays with day and week comparisons, on the smallest folder."""
    return queries()["fct_route_delay_daily_compare"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = transit_queries()
    if _has_text_operators():
        found |= importlib.import_module("headway.llm.queries").queries()
        found["pipeline"] = importlib.import_module("corpus_pipeline").run
    return found


def oracle_sql() -> dict[str, str]:
    found = oracle.statements()
    if _has_text_operators():
        found |= importlib.import_module("headway.llm.queries").oracle_sql()
        statement = importlib.import_module("corpus_pipeline").ORACLE_SQL
        found |= {"pipeline": statement} if statement else {}
    return found


def _has_text_operators() -> bool:
    """Whether the subpackage of text operators, which can be left out, is there."""
    return all(importlib.util.find_spec(name) for name in ("headway.llm", "headway.llm.queries", "corpus_pipeline"))


def transit_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def over(build: Callable[[Lineage], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(Lineage(spark, sf_dir))

    def metrics(build: Callable[[Lineage], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: _rounded(build(Lineage(spark, sf_dir)))

    at = F.col
    return {
        "raw_trip_updates": over(lambda m: m.raw_trip()),
        "raw_vehicle_positions": over(lambda m: m.raw_vehicle()),
        "flatten_trip_updates": over(
            lambda m: feeds.flatten_trip_updates(event_stream.trip_feed(m.source), at("ingested_at"))
        ),
        "flatten_vehicle_positions": over(
            lambda m: feeds.flatten_vehicle_positions(event_stream.vehicle_feed(m.source), at("ingested_at"))
        ),
        "stg_trip_updates": over(lambda m: m.staged()),
        "stg_vehicle_positions": over(lambda m: m.pings()),
        "int_trip_stop_events_deduped": over(lambda m: m.events()),
        "incremental_upsert": _incremental_upsert,
        "int_route_delay_hourly": metrics(lambda m: m.hourly()),
        "fct_route_delay_hourly": metrics(lambda m: delays.fct_route_delay_hourly(m.hourly())),
        "fct_route_delay_daily": metrics(lambda m: m.daily()),
        "fct_route_delay_daily_compare": metrics(lambda m: m.compare()),
        "fct_route_delay_daily_compare_calendar": metrics(
            lambda m: delays.fct_route_delay_daily_compare_calendar(m.daily())
        ),
        "fct_route_delay_daily_rolling": metrics(lambda m: delays.fct_route_delay_daily_rolling(m.daily())),
        "dim_route": over(lambda m: dimensions.dim_route(m.events())),
        "dim_date": over(lambda m: dimensions.dim_date(m.events())),
        "fct_latest_vehicle_positions": over(lambda m: m.live()),
        "mart_data_freshness": over(lambda m: m.freshness()),
        "freshness_alert": over(lambda m: freshness.freshness_alert(m.freshness())),
        "source_freshness": over(
            lambda m: freshness.source_freshness(
                {"raw_trip_updates": m.raw_trip(), "raw_vehicle_positions": m.raw_vehicle()}, AS_OF
            )
        ),
        "network_avg_delay": metrics(lambda m: dashboard.network_avg_delay(m.daily())),
        "daily_delay_trend": metrics(lambda m: dashboard.daily_delay_trend(m.daily())),
        "hourly_intensity_pivot": metrics(lambda m: dashboard.hourly_intensity_pivot(m.hourly())),
        "delay_heatmap_grid": metrics(lambda m: dashboard.delay_heatmap_grid(m.live())),
        # The data ends a day before AS_OF, so the 20-minute rule would keep no vehicle.
        "active_vehicles": over(lambda m: dashboard.active_vehicles(m.live(), ghost_after_min=2880)),
        "worst_delays_topk": over(lambda m: dashboard.worst_delays_topk(m.live(), k=10)),
        "routes_getting_slower": metrics(lambda m: dashboard.routes_getting_slower(m.compare())),
        "route_delay_percentiles": _delay_percentiles,
        "dq_results": _dq_results,
        "stream_golden_replay": lambda spark, sf_dir: increments.events_table(spark, _replayed(spark, sf_dir)).read(),
        "stream_hourly_replay": lambda spark, sf_dir: _rounded(
            increments.hourly_table(spark, _replayed(spark, sf_dir)).read()
        ),
        "stream_daily_replay": lambda spark, sf_dir: _rounded(
            increments.daily_table(spark, _replayed(spark, sf_dir)).read()
        ),
        "stream_feed_ingest": _ingested,
        "stream_live_replay": _live_replay,
        "stream_vehicle_ingest": _vehicles_ingested,
        "stream_dq_totals": _stream_totals,
        "stream_quarantine": _quarantine,
        "flatten_trip_polls": lambda spark, sf_dir: _polled(
            spark, sf_dir, event_stream.trip_polls, schemas.TRIP_FEED, feeds.flatten_trip_updates
        ),
        "flatten_vehicle_polls": lambda spark, sf_dir: _polled(
            spark, sf_dir, event_stream.vehicle_polls, schemas.VEHICLE_FEED, feeds.flatten_vehicle_positions
        ),
        "stream_freshness_notes": _freshness_notes,
        "stream_distinct_pings": lambda spark, sf_dir: ping_stream.read_kept(spark, _sorted_pings(spark, sf_dir)).drop(
            "batch", "ping_date"
        ),
        "stream_ping_account": lambda spark, sf_dir: ping_stream.read_account(spark, _sorted_pings(spark, sf_dir)),
        # Pings carry the start of their day, so a quarter past midnight the rule keeps some.
        "active_vehicles_now": over(
            lambda m: dashboard.active_vehicles(
                fleet.fct_latest_vehicle_positions(m.pings(), m.staged(), AFTER_MIDNIGHT)
            ).where(F.col("minutes_since_update") >= 0)
        ),
        "raw_vehicle_log": _vehicle_log,
        "mixed_log_append": _mixed_log,
        "feed_rejects": _feed_rejects,
        "project_build": _project_build,
        "project_models": _project_models,
        "freshness_now": _freshness_now,
        "daily_delay_trend_compare": metrics(lambda m: dashboard.daily_delay_trend_compare(m.daily())),
        "failing_rows": over(
            lambda m: failing_rows(m.staged(), Check("stg_trip_updates", "trip_id", "not_null")).select(
                "event_key", "route_id", "entity_id"
            )
        ),
        "stream_hourly_windows": lambda spark, sf_dir: _rounded(_hourly_windows(spark, sf_dir)),
    }
