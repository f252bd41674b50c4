"""Time expressions on zone-free UTC timestamps.

``date_trunc`` and ``timestampdiff`` go through the session zone when given TIMESTAMP_NTZ, so
these use date and interval arithmetic, which does not.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"


def utc_literal(moment: dt.datetime | str) -> Column:
    """A timestamp literal; aware datetimes are moved to UTC, naive ones and text are taken as UTC."""
    if isinstance(moment, dt.datetime):
        if moment.tzinfo is not None:
            moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
        moment = moment.isoformat(sep=" ")
    return F.lit(moment).cast("timestamp_ntz")


def utc_now() -> Column:
    """Query start time; inside a stream, the time of the micro-batch."""
    return from_instant(F.current_timestamp())


def as_of_column(as_of: Column | dt.datetime | str | None) -> Column:
    if as_of is None:
        return utc_now()
    return as_of if isinstance(as_of, Column) else utc_literal(as_of)


def epoch_to_utc(seconds: Column) -> Column:
    """Epoch seconds to UTC; 0 and null mean 'not set'."""
    return F.timestamp_add("SECOND", F.nullif(seconds, F.lit(0).cast("bigint")), utc_literal(EPOCH))


def to_instant(moment: Column) -> Column:
    """UTC wall clock to a zoned timestamp, which watermarks ask for."""
    seconds = (moment - utc_literal(EPOCH)).cast("interval second").cast("decimal(18,6)")
    return F.timestamp_micros((seconds * 1_000_000).cast("bigint"))


def from_instant(moment: Column) -> Column:
    """Zoned timestamp to UTC wall clock."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(moment), utc_literal(EPOCH))


def hour_start(moment: Column) -> Column:
    return F.timestamp_add("HOUR", F.hour(moment), F.to_date(moment).cast("timestamp_ntz"))


def whole_minutes_between(start: Column, end: Column) -> Column:
    """Complete minutes from start to end, cut towards zero."""
    return (end - start).cast("interval minute").cast("bigint")


def whole_hours_between(start: Column, end: Column) -> Column:
    """Complete hours from start to end, cut towards zero."""
    return (end - start).cast("interval hour").cast("bigint")
