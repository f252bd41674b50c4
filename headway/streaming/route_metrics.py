"""Golden events and route metrics kept up to date by micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway import schemas
from headway.plans.delays import delay_counts, hourly_of_counts
from headway.plans.increments import apply_raw, counts_table, daily_table, events_table, hourly_table, refresh_metrics
from headway.streaming import triggered
from headway.streaming.feeds import read_log_stream

_COUNTS = "route_id string, event_hour timestamp_ntz, delay_sec int, n bigint"


def stream_route_metrics(
    spark: SparkSession, trip_log: str, warehouse: str, checkpoint: str, every: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Upserts each batch's events, then carries what it changed into the metrics.

    A revised prediction takes its event out of one hour and puts it into another, which an
    append-only window cannot undo; the signed counts of the upsert do. Batches may repeat
    after a failure; both steps then arrive at the same tables.
    """

    def apply_batch(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        events = events_table(session, warehouse)
        apply_raw(events, batch)
        derived = (make(session, warehouse) for make in (counts_table, hourly_table, daily_table))
        refresh_metrics(events, *derived)

    log = read_log_stream(spark, trip_log, schemas.RAW_TRIP_UPDATES, max_files)
    writer = log.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply_batch)
    return triggered(writer, every).start()


def stream_delay_counts(events: DataFrame, counts: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Counts a stream of events that are never revised, one folder of counts per micro-batch.

    Counts add up, so it does not matter how events are dealt to batches or how late one
    comes: no watermark closes an hour and no event is dropped. A repeated batch replaces
    its own folder.
    """

    def count_batch(batch: DataFrame, batch_id: int) -> None:
        delay_counts(batch).write.mode("overwrite").parquet(f"{counts}/batch={batch_id}")

    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(count_batch)
    return triggered(writer, every).start()


def hourly_windows(spark: SparkSession, counts: str) -> DataFrame:
    """Hourly metrics of all events counted so far, with exact percentiles."""
    read = spark.read.schema(f"{_COUNTS}, batch bigint").parquet(counts)
    return hourly_of_counts(read.groupBy("route_id", "event_hour", "delay_sec").agg(F.sum("n").alias("n")))
