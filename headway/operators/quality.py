"""Declared data checks and their results.

A result is a row, not an exception: real feeds are expected to fail some of them.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.plans.staging import EVENT_TYPES


class Check(NamedTuple):
    model: str
    column: str
    test: str
    values: tuple[str, ...] = ()


# The checks of every model, in lineage order.
CHECKS = (
    Check("stg_trip_updates", "event_key", "unique"),
    Check("stg_trip_updates", "event_key", "not_null"),
    Check("stg_trip_updates", "event_time", "not_null"),
    Check("stg_trip_updates", "event_type", "accepted_values", EVENT_TYPES),
    Check("stg_trip_updates", "trip_id", "not_null"),
    Check("stg_trip_updates", "route_id", "not_null"),
    Check("stg_vehicle_positions", "vehicle_event_key", "unique"),
    Check("stg_vehicle_positions", "vehicle_event_key", "not_null"),
    Check("stg_vehicle_positions", "vehicle_id", "not_null"),
    Check("stg_vehicle_positions", "timestamp", "not_null"),
    Check("int_trip_stop_events_deduped", "event_key", "unique"),
    Check("int_trip_stop_events_deduped", "event_key", "not_null"),
    Check("int_trip_stop_events_deduped", "route_id", "not_null"),
    Check("int_trip_stop_events_deduped", "event_time", "not_null"),
    Check("int_route_delay_hourly", "route_id", "not_null"),
    Check("int_route_delay_hourly", "event_hour", "not_null"),
    Check("dim_route", "route_id", "not_null"),
    Check("dim_route", "route_id", "unique"),
    Check("dim_date", "date_day", "not_null"),
    Check("dim_date", "date_day", "unique"),
    Check("fct_route_delay_hourly", "route_id, event_hour", "unique"),
    Check("fct_route_delay_hourly", "route_id", "not_null"),
    Check("fct_route_delay_hourly", "event_hour", "not_null"),
    Check("fct_route_delay_daily", "route_id", "not_null"),
    Check("fct_route_delay_daily", "date_day", "not_null"),
    Check("fct_route_delay_daily_compare", "route_id", "not_null"),
    Check("fct_route_delay_daily_compare", "date_day", "not_null"),
    Check("fct_latest_vehicle_positions", "vehicle_id", "not_null"),
    Check("fct_latest_vehicle_positions", "vehicle_id", "unique"),
)


def _all_present(columns: list[str]) -> Column:
    present = F.lit(True)
    for name in columns:
        present = present & F.col(name).isNotNull()
    return present


def _row_failures(check: Check) -> Column:
    value = F.col(check.column)
    if check.test == "not_null":
        return F.count_if(value.isNull())
    return F.count_if(~value.isin(*check.values))


def _label(position: int) -> str:
    return f"check_{position}"


def check_model(df: DataFrame, model: str, checks: list[Check]) -> DataFrame:
    """All checks of one model in one pass.

    With a unique check the rows are first counted per key, which also carries the
    row-level failures; rows already partitioned by that key are not shuffled again. Null
    keys count as distinct values would in a unique index: they never fail.
    """
    numbered = list(enumerate(checks))
    by_row = [(i, c) for i, c in numbered if c.test != "unique"]
    unique = [(i, c) for i, c in numbered if c.test == "unique"]
    if len(unique) > 1:
        raise ValueError(f"{model}: one unique check per model")
    totals = [_row_failures(c).alias(_label(i)) for i, c in by_row]
    if unique:
        position, check = unique[0]
        keys = [name.strip() for name in check.column.split(",")]
        per_key = df.groupBy(*keys).agg(F.count("*").alias("rows_of_key"), *totals)
        totals = [F.sum(_label(i)).alias(_label(i)) for i, _ in by_row]
        totals.append(F.count_if((F.col("rows_of_key") > 1) & _all_present(keys)).alias(_label(position)))
        df = per_key
    counts = df.agg(*totals)
    rows = F.array(
        *(
            F.struct(
                F.lit(model).alias("model"),
                F.lit(c.column).alias("column"),
                F.lit(c.test).alias("test"),
                F.coalesce(F.col(_label(i)), F.lit(0).cast("bigint")).alias("failures"),
            )
            for i, c in numbered
        )
    )
    return counts.select(F.inline(rows))


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows that fail a check, with all their columns; those of a repeated key all do.

    Repeated keys are counted on their own and joined back, so a key with very many rows is
    counted per task first and its rows are then split among tasks.
    """
    if check.test != "unique":
        return df.where(F.col(check.column).isNull() if check.test == "not_null" else ~F.col(check.column).isin(*check.values))
    keys = [name.strip() for name in check.column.split(",")]
    repeated = df.where(_all_present(keys)).groupBy(*(F.col(k).alias(f"repeated_{k}") for k in keys))
    repeated = repeated.agg(F.count("*").alias("rows_of_key")).where("rows_of_key > 1").drop("rows_of_key")
    same = [F.col(k) == F.col(f"repeated_{k}") for k in keys]
    return df.join(repeated, same, "left_semi")


def own_checks(model: str, checks: tuple[Check, ...] = CHECKS) -> list[Check]:
    return [c for c in checks if c.model == model]


def _fails(check: Check) -> Column:
    """Whether a row fails a row-level check; a null is no accepted value, but fails only not_null."""
    value = F.col(check.column)
    return value.isNull() if check.test == "not_null" else F.coalesce(~value.isin(*check.values), F.lit(False))


def failed_checks(model: str, checks: tuple[Check, ...] = CHECKS) -> Column:
    """The names of the row-level checks that a row of the model fails."""
    own = [c for c in own_checks(model, checks) if c.test != "unique"]
    if not own:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*(F.when(_fails(c), f"{c.test}({c.column})") for c in own)))


def split_rows(df: DataFrame, model: str, checks: tuple[Check, ...] = CHECKS) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all row-level checks of a model, and the others with the names of the
    checks they fail in ``failed``."""
    marked = df.withColumn("failed", failed_checks(model, checks))
    return marked.where(F.size("failed") == 0).drop("failed"), marked.where(F.size("failed") > 0)


def run_checks(models: Mapping[str, DataFrame], checks: tuple[Check, ...] = CHECKS) -> DataFrame:
    """One row per check of the given models: model, column, test, failures."""
    results = None
    for model, df in models.items():
        own = [c for c in checks if c.model == model]
        if own:
            part = check_model(df, model, own)
            results = part if results is None else results.unionByName(part)
    if results is None:
        raise ValueError("no checks are declared for these models")
    return results
