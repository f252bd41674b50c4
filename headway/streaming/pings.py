"""Distinct pings of a stream, with an account of every row that arrived.

A ping is kept when its first copy arrives. Copies are looked for among the kept pings of the
last ``lateness`` only; what is older than that when it arrives is late, and goes to a table of
its own instead of vanishing. The account has one row per micro-batch:
arrived = kept + repeated + late + unusable.

    <target>/kept/batch=3/ping_date=2024-01-05/part-*.parquet
    <target>/late/batch=3/part-*.parquet
    <target>/account/batch=3/part-*.parquet

A repeated batch replaces its own folders and looks only at those of earlier batches.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway import schemas
from headway.functions import utc_literal
from headway.operators.latest import latest_per_key
from headway.plans.live import seen_at
from headway.plans.staging import NEWEST_PING, clean_vehicle_positions
from headway.streaming import triggered
from headway.streaming.feeds import read_log_stream

_BATCH = "batch bigint"
ACCOUNT = "arrived bigint, kept bigint, repeated bigint, late bigint, unusable bigint, newest timestamp_ntz"
_PINGS = schemas.MODELS["stg_vehicle_positions"]


def read_account(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(f"{ACCOUNT}, {_BATCH}").parquet(f"{target}/account")


def read_kept(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(f"{_PINGS}, {_BATCH}, ping_date date").parquet(f"{target}/kept")


def read_late(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(f"{_PINGS}, {_BATCH}").parquet(f"{target}/late")


def _written(rows: DataFrame, folder: str, *partition: str) -> int:
    counted = Observation()
    rows.observe(counted, F.count("*").alias("rows")).write.mode("overwrite").partitionBy(*partition).parquet(folder)
    return counted.get["rows"]


def sort_batch(batch: DataFrame, batch_id: int, target: str, lateness: dt.timedelta) -> None:
    """Puts the pings of one batch where they belong, and accounts for them.

    The first copy is that of the first ingestion, then feed time and entity id. Rows without a
    vehicle or a time are unusable. A ping is as old as its time says, but no younger than its
    arrival, so a clock that runs ahead makes nothing late.
    """
    spark = batch.sparkSession
    earlier = F.col("batch") < batch_id
    newest = read_account(spark, target).where(earlier).agg(F.max("newest")).first()[0] if batch_id else None
    cleaned = clean_vehicle_positions(batch)
    usable = cleaned.where(F.col("vehicle_event_key").isNotNull())
    late, on_time = usable.limit(0), usable
    if newest is not None:
        horizon = newest - lateness
        is_late = seen_at() < utc_literal(horizon)
        late, on_time = usable.where(is_late), usable.where(~is_late)
    first = latest_per_key(on_time, ["vehicle_event_key"], [F.asc(c) for c in NEWEST_PING])
    if newest is not None:
        # Nothing on time is older than the horizon, and no kept copy of it either.
        recent = read_kept(spark, target).where(earlier & (F.col("ping_date") >= F.lit(horizon.date())))
        first = first.join(recent.select("vehicle_event_key"), "vehicle_event_key", "left_anti").select(*usable.columns)
    kept = _written(first.withColumn("ping_date", F.to_date("timestamp")), f"{target}/kept/batch={batch_id}", "ping_date")
    refused = _written(late, f"{target}/late/batch={batch_id}")
    arrived = batch.count()
    found = usable.agg(F.count("*").alias("rows"), F.max(seen_at()).cast("string").alias("newest")).first()
    numbers = {
        "arrived": arrived,
        "kept": kept,
        "repeated": found["rows"] - kept - refused,
        "late": refused,
        "unusable": arrived - found["rows"],
    }
    row = [F.lit(n).cast("bigint").alias(name) for name, n in numbers.items()]
    newest_note = F.lit(found["newest"]).cast("timestamp_ntz").alias("newest")
    spark.range(0, 1, 1, 1).select(*row, newest_note).write.mode("overwrite").parquet(f"{target}/account/batch={batch_id}")


def stream_distinct_pings(
    spark: SparkSession, vehicle_log: str, target: str, checkpoint: str, lateness: dt.timedelta, every: str | None = None
) -> StreamingQuery:
    log = read_log_stream(spark, vehicle_log, schemas.RAW_VEHICLE_POSITIONS)
    writer = log.writeStream.option("checkpointLocation", checkpoint)
    return triggered(
        writer.foreachBatch(lambda batch, batch_id: sort_batch(batch, batch_id, target, lateness)), every
    ).start()
