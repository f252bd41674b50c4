"""All models in lineage order, and a run over the ones wanted."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from headway import schemas
from headway.functions.clock import as_of_column
from headway.operators.quality import run_checks
from headway.plans import delays, dimensions, events, fleet, freshness, increments, staging
from headway.sources.raw_log import read_newest
from headway.sources.table import StoredTable

STAGED_UPDATES = increments.STAGED_UPDATES
STAGED_PINGS = increments.STAGED_PINGS
EVENTS = increments.EVENTS
HOURLY = "int_route_delay_hourly"
HOURLY_MART = increments.HOURLY
DAILY = increments.DAILY
RAW_UPDATES = "raw_trip_updates"
RAW_PINGS = "raw_vehicle_positions"


class Model(NamedTuple):
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    kind: str
    tags: tuple[str, ...] = ()
    timed: bool = False


# Lineage order. Kinds and tags are fixed values.
MODELS: dict[str, Model] = {
    STAGED_UPDATES: Model(staging.stg_trip_updates, (RAW_UPDATES,), "view", ("daily_run",)),
    STAGED_PINGS: Model(staging.stg_vehicle_positions, (RAW_PINGS,), "view", ("daily_run",)),
    EVENTS: Model(events.int_trip_stop_events_deduped, (STAGED_UPDATES,), "incremental"),
    HOURLY: Model(delays.int_route_delay_hourly, (EVENTS,), "view"),
    "dim_route": Model(dimensions.dim_route, (EVENTS,), "table", ("bi_layer",)),
    "dim_date": Model(dimensions.dim_date, (EVENTS,), "table", ("bi_layer",)),
    HOURLY_MART: Model(delays.fct_route_delay_hourly, (HOURLY,), "table", ("bi_layer",)),
    DAILY: Model(delays.fct_route_delay_daily, (HOURLY,), "table", ("bi_layer",)),
    "fct_route_delay_daily_compare": Model(delays.fct_route_delay_daily_compare, (DAILY,), "table", ("bi_layer",)),
    "fct_route_delay_daily_rolling": Model(delays.fct_route_delay_daily_rolling, (DAILY,), "table", ("bi_layer",)),
    "fct_latest_vehicle_positions": Model(
        fleet.fct_latest_vehicle_positions,
        (STAGED_PINGS, STAGED_UPDATES),
        "table",
        ("bi_layer", "vehicle_positions"),
        timed=True,
    ),
    "mart_data_freshness": Model(
        freshness.mart_data_freshness, (STAGED_UPDATES,), "view", ("bi_layer",), timed=True
    ),
}


def tagged(tags: Iterable[str]) -> list[str]:
    wanted = set(tags)
    return [name for name, model in MODELS.items() if wanted & set(model.tags)]


class Project:
    """Raw logs, a warehouse folder, and the models between them.

    The staged feeds, the events and the two route metrics they feed are kept up to date by
    increments; a run reads only raw rows newer than what they hold. The staged feeds hold
    what their views would return. The small marts after them are rebuilt.
    """

    def __init__(self, spark: SparkSession, trip_log: str, vehicle_log: str, warehouse: str):
        self.spark = spark
        self.trip_log = trip_log
        self.vehicle_log = vehicle_log
        self.warehouse = warehouse.rstrip("/")
        self.kept = {
            STAGED_UPDATES: increments.staged_updates_table(spark, self.warehouse),
            STAGED_PINGS: increments.staged_pings_table(spark, self.warehouse),
            EVENTS: increments.events_table(spark, self.warehouse),
            HOURLY_MART: increments.hourly_table(spark, self.warehouse),
            DAILY: increments.daily_table(spark, self.warehouse),
        }
        self.counts = increments.counts_table(spark, self.warehouse)

    def table(self, name: str) -> StoredTable:
        return self.kept.get(name) or StoredTable(self.spark, f"{self.warehouse}/{name}", schemas.MODELS[name])

    def read(self, name: str, as_of=None) -> DataFrame:
        """A stored model, or a view over stored ones."""
        if name == HOURLY:
            # The hourly mart holds the same rows, already aggregated.
            return self.table(HOURLY_MART).read().drop("date_day")
        model = MODELS[name]
        if model.kind == "view" and name not in self.kept:
            return self._compute(name, as_of)
        return self.table(name).read().select(*schemas.struct(schemas.MODELS[name]).fieldNames())

    def _compute(self, name: str, as_of=None) -> DataFrame:
        model = MODELS[name]
        inputs = [self.read(i) for i in model.inputs]
        return model.build(*inputs, as_of_column(as_of)) if model.timed else model.build(*inputs)

    def _bring_up_to_date(self, names: set[str], full_refresh: bool) -> None:
        staged, pings, events = (self.kept[n] for n in (STAGED_UPDATES, STAGED_PINGS, EVENTS))
        if {STAGED_UPDATES, EVENTS} <= names:
            increments.stage_and_load(staged, events, self.trip_log, full_refresh)
        elif STAGED_UPDATES in names:
            increments.stage_new_updates(staged, self.trip_log, full_refresh)
        if STAGED_PINGS in names:
            increments.stage_new_pings(pings, self.vehicle_log, full_refresh)
        if EVENTS in names and STAGED_UPDATES not in names:
            increments.load_new_events(events, self.trip_log, full_refresh)
        if names & {HOURLY, HOURLY_MART, DAILY}:
            increments.refresh_metrics(events, self.counts, self.kept[HOURLY_MART], self.kept[DAILY])

    def _require_inputs(self, wanted: list[str]) -> None:
        """A stored input that is not built now must have been built before."""
        stored = {
            HOURLY_MART if i == HOURLY else i
            for name in wanted
            for i in MODELS[name].inputs
            if i in MODELS and i not in wanted and (MODELS[i].kind != "view" or i == HOURLY)
        }
        missing = sorted(name for name in stored - set(wanted) if not self.table(name).versions())
        if missing:
            raise ValueError(f"not built yet, build them first: {', '.join(missing)}")

    def build(
        self, tags: Iterable[str] | None = None, as_of=None, full_refresh: bool = False
    ) -> dict[str, DataFrame]:
        """Builds the models carrying one of the tags, or all, and returns them by name.

        Views a wanted model reads are brought up to date first, stored inputs are taken as
        they are. ``full_refresh`` starts again from the whole logs.
        """
        wanted = list(MODELS) if tags is None else tagged(tags)
        self._require_inputs(wanted)
        views_read = {i for name in wanted for i in MODELS[name].inputs if i in MODELS and MODELS[i].kind == "view"}
        self._bring_up_to_date(views_read | set(wanted), full_refresh)
        built: dict[str, DataFrame] = {}
        for name in wanted:
            if MODELS[name].kind == "table" and name not in self.kept:
                self.table(name).replace(self._compute(name, as_of))
            built[name] = self.read(name, as_of)
            built[name].createOrReplaceTempView(name)
        return built

    def drop_old_versions(self, keep: int = 3) -> None:
        """Frees the space of versions before the last few; their readers must be done."""
        for table in [self.counts, *(self.table(name) for name in MODELS)]:
            if table.versions():
                table.drop_old(keep)

    def source_freshness(self, as_of=None) -> DataFrame:
        logs = {
            RAW_UPDATES: read_newest(self.spark, self.trip_log, schemas.RAW_TRIP_UPDATES),
            RAW_PINGS: read_newest(self.spark, self.vehicle_log, schemas.RAW_VEHICLE_POSITIONS),
        }
        return freshness.source_freshness(logs, as_of)

    def test(self, built: dict[str, DataFrame] | None = None) -> DataFrame:
        """Results of the declared checks for the given or all models."""
        return run_checks(built or {name: self.read(name) for name in MODELS})
