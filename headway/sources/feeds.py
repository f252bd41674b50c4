"""Feed messages to raw log rows.

A feed message is one row with a header and an array of entities (``schemas.TRIP_FEED``,
``schemas.VEHICLE_FEED``). The same functions serve batch and streaming input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway import schemas
from headway.functions import epoch_to_utc, utc_now, zero_to_null

TRIP_SOURCE = "gtfs_rt_trip_updates"
VEHICLE_SOURCE = "gtfs_rt_vehicle_positions"


# Names of the feed's enumerations; some writers give names for numbers.
ENUMS = {
    "schedule_relationship": {
        "SCHEDULED": 0, "ADDED": 1, "UNSCHEDULED": 2, "CANCELED": 3, "REPLACEMENT": 5, "DUPLICATED": 6, "DELETED": 7,
    },
    "current_status": {"INCOMING_AT": 0, "STOPPED_AT": 1, "IN_TRANSIT_TO": 2},
}


def landed(ddl: str) -> T.StructType:
    """The schema to read JSON messages with: numbers as text, for writers differ in how they
    give long numbers and enumerations."""
    return _as_text(schemas.struct(ddl))


def _as_text(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType))
    return T.StringType()


def typed(feed: DataFrame, ddl: str, strict: bool = True) -> DataFrame:
    """Messages read as text with their declared types. Text that is neither a number nor a
    name of its enumeration stops the job, or becomes null where ``strict`` is off."""
    fields = schemas.struct(ddl)
    return feed.select(*(_typed(F.col(f.name), f.dataType, f.name, strict).alias(f.name) for f in fields))


def _typed(value: Column, kind: T.DataType, name: str, strict: bool) -> Column:
    if isinstance(kind, T.StructType):
        whole = F.struct(*(_typed(value[f.name], f.dataType, f.name, strict).alias(f.name) for f in kind))
        return F.when(value.isNotNull(), whole)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _typed(item, kind.elementType, name, strict))
    if isinstance(kind, T.StringType):
        return value
    if name in ENUMS:
        # One look-up: a chain of replacements names its value twice a step and doubles the work.
        numbers = F.create_map(*(F.lit(x) for text, number in ENUMS[name].items() for x in (text, str(number))))
        value = F.coalesce(F.try_element_at(numbers, F.upper(value)), value)
    return value.cast(kind) if strict else value.try_cast(kind)


def read_feed(spark: SparkSession, path: str, schema: str, fmt: str = "json", **options) -> DataFrame:
    """Landed feed snapshots, one message per row: JSON lines or nested parquet.

    Give ``multiLine=True`` for JSON files that hold one message over several lines. A file
    that is cut off or otherwise not as declared stops the job; ``split_feed`` sets such
    messages aside instead.
    """
    if fmt != "json":
        return spark.read.schema(schema).format(fmt).options(**options).load(path)
    return typed(spark.read.schema(landed(schema)).options(mode="FAILFAST", **options).json(path), schema)


def split_feed(spark: SparkSession, path: str, schema: str, **options) -> tuple[DataFrame, DataFrame]:
    """Good messages, and rejects as (file, message, reason): unreadable JSON, text in place
    of a number, or a message without header or entities."""
    rejected = "rejected_text"
    text = T.StructType([*landed(schema), T.StructField(rejected, T.StringType())])
    read = spark.read.schema(text).options(mode="PERMISSIVE", columnNameOfCorruptRecord=rejected, **options).json(path)
    read = read.select("*", F.col("_metadata.file_path").alias("file"))
    convertible = F.lit(True)
    for field in schemas.struct(schema):
        convertible = convertible & _convertible(F.col(field.name), field.dataType, field.name)
    reason = (
        F.when(F.col(rejected).isNotNull(), "unreadable")
        .when(F.col("header").isNull() | F.col("entity").isNull(), "no message")
        .when(~convertible, "not a number")
    )
    read = read.select("*", reason.alias("reason"), F.to_json(F.struct("header", "entity")).alias("message"))
    # Convertible by now; a strict cast might be evaluated before the filter.
    good = typed(read.where(F.col("reason").isNull()), schema, strict=False)
    bad = read.where(F.col("reason").isNotNull())
    return good, bad.select("file", F.coalesce(rejected, "message").alias("message"), "reason")


def _convertible(value: Column, kind: T.DataType, name: str) -> Column:
    if isinstance(kind, T.StructType):
        parts = F.lit(True)
        for f in kind:
            parts = parts & _convertible(value[f.name], f.dataType, f.name)
        return value.isNull() | parts
    if isinstance(kind, T.ArrayType):
        return value.isNull() | F.forall(value, lambda item: _convertible(item, kind.elementType, name))
    if isinstance(kind, T.StringType):
        return F.lit(True)
    known = F.upper(value).isin(*ENUMS[name]) if name in ENUMS else F.lit(False)
    return value.isNull() | known | value.try_cast(kind).isNotNull()


def _not_blank(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def _or_empty(value: Column) -> Column:
    """Unset text reads as empty, as the feed's wire format defines."""
    return F.coalesce(value, F.lit(""))


def _or_zero(value: Column) -> Column:
    return F.coalesce(value.cast("double"), F.lit(0.0))


def _entities(feed: DataFrame, batch_time: Column) -> DataFrame:
    """A row per entity. As ``explode``, but the planner derives no filter on the array from this
    form, which would compute all its typed values again, twice."""
    rows = feed.select(
        batch_time.alias("ingested_at"),
        epoch_to_utc(F.col("header.timestamp")).alias("feed_timestamp"),
        F.posexplode_outer("entity").alias("place", "entity"),
    )
    return rows.where(F.col("place").isNotNull()).drop("place")


def flatten_trip_updates(
    feed: DataFrame,
    ingested_at: Column | None = None,
    source: str = TRIP_SOURCE,
    zero_delay_is_null: bool = True,
) -> DataFrame:
    """One row per stop update and per arrival or departure that has a time.

    The feed does not tell a delay of 0 from an unset one; both become null unless
    ``zero_delay_is_null`` is off.
    """
    batch_time = utc_now() if ingested_at is None else ingested_at
    stops = _entities(feed, batch_time).select(
        "ingested_at",
        "feed_timestamp",
        F.col("entity.id").alias("entity_id"),
        F.col("entity.trip_update.trip").alias("trip"),
        F.explode("entity.trip_update.stop_time_update").alias("stop"),
    )
    calls = stops.withColumn(
        "call",
        F.explode(
            F.array(
                F.struct(F.lit("ARRIVAL").alias("type"), F.col("stop.arrival").alias("at")),
                F.struct(F.lit("DEPARTURE").alias("type"), F.col("stop.departure").alias("at")),
            )
        ),
    ).where(F.col("call.at.time") != 0)
    delay = F.col("call.at.delay")
    return calls.select(
        "ingested_at",
        "feed_timestamp",
        F.lit(source).alias("source"),
        _or_empty(F.col("entity_id")).alias("entity_id"),
        *(_or_empty(F.col(f"trip.{c}")).alias(c) for c in ("trip_id", "route_id", "start_date", "start_time")),
        _not_blank(F.col("stop.stop_id")).alias("stop_id"),
        zero_to_null(F.col("stop.stop_sequence")).alias("stop_sequence"),
        F.col("call.type").alias("event_type"),
        epoch_to_utc(F.col("call.at.time")).alias("event_time"),
        (zero_to_null(delay) if zero_delay_is_null else delay).alias("delay_sec"),
        F.coalesce(F.col("trip.schedule_relationship"), F.lit(0)).cast("string").alias("schedule_relationship"),
        F.lit(None).cast("string").alias("raw_json"),
    )


def flatten_vehicle_positions(
    feed: DataFrame, ingested_at: Column | None = None, source: str = VEHICLE_SOURCE
) -> DataFrame:
    """One row per entity. Unset ids read as empty text and unset numbers as 0."""
    batch_time = utc_now() if ingested_at is None else ingested_at
    pings = _entities(feed, batch_time).select("ingested_at", "feed_timestamp", F.col("entity.id").alias("entity_id"), F.col("entity.vehicle").alias("v"))
    return pings.select(
        "ingested_at",
        "feed_timestamp",
        F.lit(source).alias("source"),
        _or_empty(F.col("entity_id")).alias("entity_id"),
        _or_empty(F.col("v.vehicle.id")).alias("vehicle_id"),
        _or_empty(F.col("v.trip.trip_id")).alias("trip_id"),
        _or_empty(F.col("v.trip.route_id")).alias("route_id"),
        _or_zero(F.col("v.position.latitude")).alias("position_lat"),
        _or_zero(F.col("v.position.longitude")).alias("position_lon"),
        _or_zero(F.col("v.position.bearing")).alias("bearing"),
        _or_zero(F.col("v.position.speed")).alias("speed"),
        F.coalesce(F.col("v.current_status"), F.lit(2)).cast("string").alias("current_status"),
        zero_to_null(F.col("v.current_stop_sequence")).alias("current_stop_sequence"),
        _not_blank(F.col("v.stop_id")).alias("stop_id"),
        epoch_to_utc(F.col("v.timestamp")).alias("timestamp"),
        F.lit(None).cast("string").alias("raw_json"),
    )
