"""Live fleet, distinct pings and freshness kept up to date by micro-batches."""

from __future__ import annotations

import datetime as dt
import threading
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from headway import schemas
from headway.functions import to_instant
from headway.plans import live
from headway.plans.freshness import mart_data_freshness
from headway.plans.increments import stage_pings, stage_updates, staged_pings_table, staged_updates_table
from headway.plans.staging import (
    NEWEST_PING,
    NEWEST_UPDATE,
    clean_trip_updates,
    clean_vehicle_positions,
    usable_update,
)
from headway.streaming import triggered
from headway.streaming.feeds import read_log_stream

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LATENESS = dt.timedelta(days=2)
_OBSERVED = "freshness"


def _stream(spark, log, schema, checkpoint, every, apply_batch, shaped=lambda rows: rows, mode="append") -> StreamingQuery:
    rows = shaped(read_log_stream(spark, log, schema))
    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return triggered(writer.foreachBatch(apply_batch), every).start()


def _with_rocksdb(spark: SparkSession) -> None:
    """State that outgrows memory lives in RocksDB; a running query's store is not changed."""
    spark.conf.set(_STATE_STORE, _ROCKSDB)


def newest_copies(cleaned: DataFrame, keys: list[str], schema: str, order: tuple[str, ...]) -> DataFrame:
    """Streaming: the newest copy per key so far. Map tasks keep one copy per key before the
    shuffle, so a key with a third of the rows reaches its state as one row per task."""
    kept = [c for c in live.columns(schema) if c not in keys]
    newest = F.max_by(F.struct(*kept), F.struct(*order)).alias("newest")
    return cleaned.groupBy(*keys).agg(newest).select(*keys, "newest.*")


def stream_trip_delays(
    spark: SparkSession, trip_log: str, warehouse: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Keeps the newest delay per trip. State holds the newest prediction per stop event; a
    batch passes on the events it changed."""
    _with_rocksdb(spark)

    def shaped(log: DataFrame) -> DataFrame:
        return newest_copies(clean_trip_updates(log), ["event_key"], live.PREDICTIONS, NEWEST_UPDATE)

    def apply_batch(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        tables = live.predictions_table(session, warehouse), live.trip_delays_table(session, warehouse)
        live.apply_predictions(*tables, batch)

    return _stream(spark, trip_log, schemas.RAW_TRIP_UPDATES, checkpoint, every, apply_batch, shaped, "update")


def stream_positions(
    spark: SparkSession, vehicle_log: str, warehouse: str, checkpoint: str, every: str | None = None,
    lateness: dt.timedelta = LATENESS,
) -> StreamingQuery:
    """Keeps the newest position per vehicle. State holds the last copy of every ping of the
    last ``lateness``; the watermark evicts older ones and refuses their copies."""
    _with_rocksdb(spark)

    def shaped(log: DataFrame) -> DataFrame:
        timed = clean_vehicle_positions(log).withColumn("seen_at", live.seen_at())
        timed = timed.withColumn("instant", to_instant(F.col("seen_at")))
        timed = timed.withWatermark("instant", f"{int(lateness.total_seconds())} seconds")
        return newest_copies(timed, ["vehicle_event_key", "instant"], live.PINGS, NEWEST_PING)

    def apply_batch(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        tables = live.pings_table(session, warehouse), live.positions_table(session, warehouse)
        live.apply_pings(*tables, batch, lateness)

    return _stream(spark, vehicle_log, schemas.RAW_VEHICLE_POSITIONS, checkpoint, every, apply_batch, shaped, "update")


def stream_staged_updates(
    spark: SparkSession, trip_log: str, warehouse: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Keeps the staged predictions. The newest feed time of the usable ones is observed as they
    pass, for a ``FreshnessMonitor``."""

    def observed(log: DataFrame) -> DataFrame:
        newest = F.max(F.when(usable_update(), F.col("feed_timestamp"))).cast("string")
        return log.observe(_OBSERVED, newest.alias("newest"))

    def apply_batch(batch: DataFrame, _: int) -> None:
        stage_updates(staged_updates_table(batch.sparkSession, warehouse), batch)

    return _stream(spark, trip_log, schemas.RAW_TRIP_UPDATES, checkpoint, every, apply_batch, observed)


def stream_staged_pings(
    spark: SparkSession, vehicle_log: str, warehouse: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    def apply_batch(batch: DataFrame, _: int) -> None:
        stage_pings(staged_pings_table(batch.sparkSession, warehouse), batch)

    return _stream(spark, vehicle_log, schemas.RAW_VEHICLE_POSITIONS, checkpoint, every, apply_batch)


class FreshnessMonitor(StreamingQueryListener):
    """Notes the newest feed time after every batch of ``stream_staged_updates``, from what the
    batch observed; no table is read for it.

    One folder per batch, so a repeated batch replaces its own note. The note of a batch
    after which the driver died is missing; the next one is newer. Feed times are taken to rise
    with ingestion: a copy replaced by one with an older feed time still counts.
    """

    def __init__(self, spark: SparkSession, warehouse: str):
        self.spark = spark
        self.notes = f"{warehouse}/freshness"
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        observed = event.progress.observedMetrics.get(_OBSERVED)
        if observed is not None and observed["newest"] is not None:
            newest = F.lit(observed["newest"]).cast("timestamp_ntz").alias("feed_timestamp")
            folder = f"{self.notes}/batch={event.progress.batchId}"
            self.spark.range(0, 1, 1, 1).select(newest).write.mode("overwrite").parquet(folder)

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Returns when all progress of a finished query has been noted."""
        if not self.ended[str(query.runId)].wait(seconds):
            raise TimeoutError(f"no end of {query.runId} was reported in {seconds} s")


def noted_freshness(spark: SparkSession, warehouse: str, as_of=None) -> DataFrame:
    """The freshness mart from the notes: one small row per batch."""
    notes = spark.read.schema("feed_timestamp timestamp_ntz").parquet(f"{warehouse}/freshness")
    return mart_data_freshness(notes, as_of)


def distinct_pings(pings: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Streaming: drops repeats of a ping, keeping the first to arrive.

    For feeds that repeat a ping unchanged and not often, as all copies of one ping pass
    through one task, and late pings are dropped uncounted; ``streaming.pings`` counts them.
    """
    timed = pings.withColumn("instant", to_instant(F.col("timestamp"))).withWatermark("instant", lateness)
    return timed.dropDuplicatesWithinWatermark(["vehicle_id", "timestamp"]).drop("instant")
