"""Runs over the whole set of models, and the declared checks."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, SF_SMALL, as_set, moment
from headway import schemas
from headway.functions import utc_literal
from headway.operators.quality import CHECKS, Check, failing_rows, run_checks, split_rows
from headway.plans import delays, fleet, freshness
from headway.plans.events import int_trip_stop_events_deduped
from headway.plans.pipeline import MODELS, Project, tagged
from headway.plans.staging import stg_trip_updates, stg_vehicle_positions
from headway.sources import event_stream
from headway.sources.raw_log import append_raw, read_newest, read_raw, read_zones
from headway.sources.scratch import new_folder

CUT = "2024-01-15 00:00:00"


@pytest.fixture(scope="module")
def run(spark):
    """A project built from half the log, then built again over all of it."""
    folder = new_folder(spark, "project")
    source = event_stream.read_events(spark, SF_SMALL)
    project = Project(spark, f"{folder}/log", f"{folder}/vlog", f"{folder}/warehouse")
    updates, pings = event_stream.raw_trip_updates(source), event_stream.raw_vehicle_positions(source)
    for part in (F.col("ingested_at") <= utc_literal(CUT), F.col("ingested_at") > utc_literal(CUT)):
        append_raw(updates.where(part), f"{folder}/log")
        append_raw(pings.where(part), f"{folder}/vlog")
        built = project.build(as_of=AS_OF)
    return project, built, updates, pings


def test_models_have_their_schemas(run):
    _, built, _, _ = run
    for name, df in built.items():
        expected = schemas.struct(schemas.MODELS[name])
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in expected], name


def test_every_model_is_built_and_viewable(run, spark):
    _, built, _, _ = run
    assert set(built) == set(MODELS) == set(schemas.MODELS)
    for name, df in built.items():
        assert spark.table(name).count() == df.count(), name


def test_increment_keeps_what_a_rebuild_drops(run):
    project, built, updates, _ = run
    assert built["int_trip_stop_events_deduped"].count() == 464
    assert int_trip_stop_events_deduped(stg_trip_updates(updates)).count() == 455


def test_marts_follow_from_the_events(run):
    _, built, updates, pings = run
    hourly = delays.int_route_delay_hourly(built["int_trip_stop_events_deduped"])
    assert as_set(built["fct_route_delay_hourly"]) == as_set(delays.fct_route_delay_hourly(hourly))
    totals = ("route_id", "date_day", "total_events")
    assert as_set(built["fct_route_delay_daily_compare"], *totals) == as_set(delays.fct_route_delay_daily(hourly), *totals)
    staged = stg_trip_updates(updates)
    live = fleet.fct_latest_vehicle_positions(stg_vehicle_positions(pings), staged, AS_OF)
    assert as_set(built["fct_latest_vehicle_positions"]) == as_set(live)
    assert as_set(built["mart_data_freshness"]) == as_set(freshness.mart_data_freshness(staged, AS_OF))


def test_daily_totals_count_the_events(run):
    _, built, _, _ = run
    events = built["int_trip_stop_events_deduped"]
    assert built["fct_route_delay_daily"].agg(F.sum("total_events")).first()[0] == events.count()
    direct = events.groupBy("route_id", F.col("event_date").alias("date_day")).agg(F.avg("delay_sec").alias("direct"))
    joined = built["fct_route_delay_daily"].join(direct, ["route_id", "date_day"])
    assert joined.where(F.abs(F.col("avg_delay_sec") - F.col("direct")) > 1e-9).count() == 0


def test_tags(run):
    project, _, _, _ = run
    assert tagged(["daily_run"]) == ["stg_trip_updates", "stg_vehicle_positions"]
    assert tagged(["vehicle_positions"]) == ["fct_latest_vehicle_positions"]
    assert len(tagged(["bi_layer"])) == 8
    assert list(project.build(tags=["vehicle_positions"], as_of=AS_OF)) == ["fct_latest_vehicle_positions"]


def test_unbuilt_inputs_are_an_error(spark, run):
    project, _, _, _ = run
    fresh = Project(spark, project.trip_log, project.vehicle_log, new_folder(spark, "fresh"))
    with pytest.raises(ValueError, match="not built yet: ?|build them first"):
        fresh.build(tags=["bi_layer"], as_of=AS_OF)


def test_failing_rows_and_split(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", None)], "k string, n int")
    checks = (Check("m", "k", "not_null"), Check("m", "n", "not_null"), Check("m", "k", "unique"))
    assert [as_set(failing_rows(rows, c)) for c in checks] == [{(None, 3)}, {("b", None)}, {("a", 1), ("a", 2)}]
    good, bad = split_rows(rows, "m", checks)
    assert as_set(good) == {("a", 1), ("a", 2)}
    assert {(r.k, r.n, tuple(r.failed)) for r in bad.collect()} == {
        (None, 3, ("not_null(k)",)), ("b", None, ("not_null(n)",))
    }


def test_source_freshness_opens_no_data_file(run, spark):
    project, _, updates, pings = run
    found = project.source_freshness(AS_OF)
    assert {f.split("/")[-3] for f in found.inputFiles()} == {"log_loads", "vlog_loads"}
    logs = {"raw_trip_updates": updates, "raw_vehicle_positions": pings}
    assert as_set(found) == as_set(freshness.source_freshness(logs, AS_OF))
    zones = read_zones(spark, project.trip_log)
    assert zones.agg(F.sum("rows")).first()[0] == updates.count() and zones.count() == 2


def test_loads_before_a_mark_are_not_opened(spark, trip_rows):
    log = f"{new_folder(spark, 'zones')}/log"
    for minute in (20, 40, 50):
        append_raw(trip_rows({"ingested_at": f"10 08:{minute}", "stop_id": f"s{minute}"}), log, f"at{minute}")
    append_raw(trip_rows({"ingested_at": "09 23:50"}, {"ingested_at": "10 08:45", "stop_id": "s45"}), log, "both")

    def opened(**mark):
        rows = read_raw(spark, log, schemas.RAW_TRIP_UPDATES, **mark)
        chosen = rows._jdf.queryExecution().optimizedPlan().toString()
        return set(re.findall(r"\bat\d\d\b", chosen)), as_set(rows, "stop_id")

    assert opened(ingested_after="2024-01-10 08:40:00") == ({"at20", "at40"}, {("s45",), ("s50",)})
    assert opened(ingested_from="2024-01-10 08:40:00") == ({"at20"}, {("s40",), ("s45",), ("s50",)})
    # A load whose writer died before its zone is read as any other.
    trip_rows({"ingested_at": "10 08:55", "stop_id": "lost"}).withColumns(
        {"ingest_date": F.to_date("ingested_at"), "load": F.lit("lost")}
    ).write.mode("append").partitionBy("ingest_date", "load").parquet(log)
    assert opened(ingested_after="2024-01-10 08:50:00")[1] == {("lost",)}
    assert read_newest(spark, log, schemas.RAW_TRIP_UPDATES).agg(F.max("ingested_at")).first()[0] == moment("10 08:55")


def test_checks_on_the_project(run):
    project, built, _, _ = run
    rows = {(r.model, r.column, r.test): r.failures for r in project.test(built).collect()}
    assert len(rows) == len(CHECKS) == 29
    assert {k: v for k, v in rows.items() if v} == {
        ("stg_trip_updates", "trip_id", "not_null"): 10,
        ("stg_vehicle_positions", "vehicle_id", "not_null"): 1,
        ("stg_vehicle_positions", "vehicle_event_key", "not_null"): 1,
        ("fct_latest_vehicle_positions", "vehicle_id", "not_null"): 1,
    }


def test_full_refresh_last(run):
    project, _, updates, _ = run
    built = project.build(as_of=AS_OF, full_refresh=True)
    rebuilt = int_trip_stop_events_deduped(stg_trip_updates(updates))
    assert as_set(built["int_trip_stop_events_deduped"]) == as_set(rebuilt)
    hourly = delays.int_route_delay_hourly(rebuilt)
    assert as_set(built["fct_route_delay_hourly"]) == as_set(delays.fct_route_delay_hourly(hourly))
    project.drop_old_versions(keep=1)
    assert len(project.table("dim_route")._names(project.table("dim_route").path + "/data")) == 1
    assert project.read("fct_latest_vehicle_positions").count() == 16


def test_check_semantics(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, "y"), ("b", None, None), (None, 2, "x"), (None, 2, "z"), ("c", 3, "x"), ("c", 3, "x"), ("c", 4, "x")],
        "k string, n int, v string",
    )
    checks = (
        Check("m", "k", "unique"),
        Check("m", "k", "not_null"),
        Check("m", "n", "not_null"),
        Check("m", "v", "accepted_values", ("x", "y")),
        Check("pair", "k, n", "unique"),
    )
    result = {(r.model, r.column, r.test): r.failures for r in run_checks({"m": rows, "pair": rows}, checks).collect()}
    assert list(result.values()) == [2, 2, 1, 1, 2]
    empty = run_checks({"m": rows.limit(0)}, checks)
    assert [r.failures for r in empty.collect()] == [0, 0, 0, 0]
    with pytest.raises(ValueError):
        run_checks({"other": rows}, checks)
