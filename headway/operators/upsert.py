"""Upsert by key into a stored table."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from headway.functions import utc_literal
from headway.sources.scratch import written
from headway.sources.table import PART, Pointer, StoredTable

NEWEST_BY = ("ingested_at", "feed_timestamp")
_KEY = "delta_key"
REPLACED = "replaced"
HIGHEST = {"mark": "ingested_at"}


def replace_matching(target: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Target rows whose key the delta lacks, plus the delta. Null keys are one key."""
    return target.join(delta.select(F.col(key).alias(_KEY)), _same(key), "left_anti").unionByName(delta)


def _same(key: str) -> Column:
    return F.col(key).eqNullSafe(F.col(_KEY))


def _found(sure: Column) -> list[Column]:
    """The distinct parts of sure and of other rows; they are bounded by the table's buckets or the
    calendar, not by the data."""
    return [F.collect_set(F.when(kind, F.col(PART))).alias(name) for name, kind in (("sure", sure), ("open", ~sure))]


def _staged(rows: DataFrame, path: str, sure: Column) -> tuple[DataFrame, list[str], list[str]]:
    """Writes the rows and returns them with the parts of the sure and of the other ones."""
    seen = Observation()
    staged = written(rows.observe(seen, *_found(sure)), path)
    return staged, seen.get["sure"], seen.get["open"]


def _newer_than_all(at: Pointer, newest_by: Sequence[str], highest: dict[str, str]) -> Column:
    """Whether a row is newer than every row held, by the maximum that the pointer notes of the
    first order column; without a note no row is known to be."""
    marks = [at.notes.get(name) for name, column in highest.items() if column == newest_by[0]]
    if not marks or marks[0] is None:
        return F.lit(False)
    return F.coalesce(F.col(newest_by[0]) > utc_literal(marks[0]), F.lit(False))


def accepted_rows(
    held: DataFrame, delta: DataFrame, key: str, newest_by: Sequence[str], tracked: Sequence[str] = ()
) -> DataFrame:
    """The delta rows that enter the table, unless the held row of their key is newer; each with
    the ``tracked`` columns of the row it replaces as ``replaced``, null for a new key."""
    narrow = held.select(
        F.col(key).alias(_KEY),
        F.struct(*newest_by).alias("held_order"),
        F.struct(F.lit(True).alias("is_held"), *tracked).alias(REPLACED),
    )
    newer = F.col("held_order") > F.struct(*newest_by)
    return delta.join(narrow, _same(key), "left").where(~F.coalesce(newer, F.lit(False))).drop(_KEY, "held_order")


def upsert(
    table: StoredTable,
    delta: DataFrame,
    key: str,
    newest_by: Sequence[str] = NEWEST_BY,
    rebuild: bool = False,
    tracked: Sequence[str] = (),
    notes: Callable[[Pointer, DataFrame | None], dict] | None = None,
    highest: dict[str, str] = HIGHEST,
    trimmed: Callable[[Pointer, DataFrame], DataFrame] | None = None,
    stored: bool = False,
) -> list[str]:
    """Merges a delta with unique keys and returns the parts that changed.

    A row's part must follow from its key, so a key is looked for in its own part only: parts
    the delta does not touch are neither read nor written. A delta row replaces the held row of
    its key unless that one is newer, so repeating an increment changes nothing. Rows newer than
    the table's mark enter without a look at the held ones; for the others first the key and
    order columns are read, then the parts that a row really enters. ``rebuild`` makes the delta
    the whole table. ``stored`` says that the delta is read from files and need not be written.

    ``notes`` makes notes of the new pointer from the old one and the accepted rows (null
    for a first load or a rebuild); ``highest`` names columns whose maximum it keeps.
    ``trimmed`` may drop rows of the parts that are written anyway.
    """
    at = table.pointer()
    noted = notes or (lambda *_: {})
    trim = trimmed or (lambda _, rows: rows)
    if rebuild or not at.parts:
        return sorted(table.replace(trim(at, delta), at=at, highest=highest, **noted(at, None)).parts)

    staging = f"{table.path}/staging/{uuid.uuid4().hex}"
    try:
        sure = _newer_than_all(at, newest_by, highest)
        delta = delta.withColumn(PART, table.part)
        if stored:
            entered, unsure = delta.agg(*_found(sure)).first()
        else:
            delta, entered, unsure = _staged(delta, f"{staging}/delta", sure)
        held = table.read(sorted({*entered, *unsure}), True, at)
        accepted, replacing = [], []
        if entered:
            accepted.append(delta.where(sure).drop(PART))
            # Read by the notes alone, which need few columns of it.
            replacing.append(accepted_rows(held, delta.where(sure), key, newest_by, tracked))
        if unsure:
            few, compared = delta, held
            if entered:
                few = written(delta.where(~sure), f"{staging}/unsure")
                compared = held.join(few.select(F.col(key).alias(_KEY)), _same(key), "left_semi")
            checked, more, _ = _staged(accepted_rows(compared, few, key, newest_by, tracked), f"{staging}/accepted", F.lit(True))
            accepted.append(checked.drop(PART, REPLACED))
            replacing.append(checked)
            entered = {*entered, *more}
        touched = sorted(entered)
        if touched:
            merged = replace_matching(table.read(touched, True, at), functools.reduce(DataFrame.unionByName, accepted), key)
            changes = functools.reduce(DataFrame.unionByName, replacing)
            table.replace(trim(at, merged), touched, at, highest, **noted(at, changes))
        return touched
    finally:
        table._delete(staging)
