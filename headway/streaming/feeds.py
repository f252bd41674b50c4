"""Landed feed files to the raw logs."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from headway import schemas
from headway.sources.feeds import flatten_trip_updates, flatten_vehicle_positions, landed, typed
from headway.sources.raw_log import LOAD, PARTITION, PARTITIONS, append_raw
from headway.streaming import triggered


def _append_stream(
    spark: SparkSession, feed_dir: str, schema: str, flatten: Callable[[DataFrame], DataFrame],
    log: str, checkpoint: str, every: str | None, options: dict,
) -> StreamingQuery:
    """Every micro-batch is one load of the log, named by the query and the batch, so that a
    replay after a failure replaces what it wrote. Rows carry their batch's time, which a
    replay repeats."""
    feed = spark.readStream.schema(landed(schema)).options(mode="FAILFAST", **options).json(feed_dir)
    rows = flatten(typed(feed, schema))
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def append_batch(batch: DataFrame, batch_id: int) -> None:
        append_raw(batch, log, f"stream-{name}-{batch_id}")

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(append_batch)
    return triggered(writer, every).start()


def stream_trip_feed(
    spark: SparkSession, feed_dir: str, log: str, checkpoint: str, every: str | None = None, **options
) -> StreamingQuery:
    return _append_stream(spark, feed_dir, schemas.TRIP_FEED, flatten_trip_updates, log, checkpoint, every, options)


def stream_vehicle_feed(
    spark: SparkSession, feed_dir: str, log: str, checkpoint: str, every: str | None = None, **options
) -> StreamingQuery:
    return _append_stream(
        spark, feed_dir, schemas.VEHICLE_FEED, flatten_vehicle_positions, log, checkpoint, every, options
    )


def read_log_stream(spark: SparkSession, log: str, schema: str, max_files: int | None = None) -> DataFrame:
    """A raw log as a stream; the checkpoint takes the place of the high-water mark."""
    reader = spark.readStream.schema(f"{schema}, {PARTITIONS}")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(log).drop(PARTITION, LOAD)
