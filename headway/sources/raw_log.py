"""Append-only raw logs, partitioned by ingestion date and load.

A load is one append or one micro-batch. Batch and streaming writers may share a log: both
write plain partitions, and a repeated micro-batch replaces the files of its own load. Beside
the log lies a small table of zones, one per load, from which marks and freshness are answered.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from headway.functions import utc_literal

PARTITION = "ingest_date"
LOAD = "load"
PARTITIONS = f"{PARTITION} date, {LOAD} string"
ROWS_PER_FILE = 5_000_000
_ZONE = "rows bigint, oldest timestamp_ntz, newest timestamp_ntz"


def append_raw(rows: DataFrame, path: str, load: str | None = None) -> int:
    """Appends in one job commit and returns the number of rows written.

    The rebalance gives every date files of a useful size whether one batch spans a day or
    a backfill spans years; AQE splits a date that outgrows one task. Writing a named load
    again replaces it where it has rows. After the rows the load's zone is written: how many
    rows it has and the first and last ingestion time.
    """
    name = load or uuid.uuid4().hex
    seen = Observation()
    (
        rows.select("*", F.to_date("ingested_at").alias(PARTITION), F.lit(name).alias(LOAD))
        .hint("rebalance", PARTITION)
        .observe(
            seen,
            F.count("*").alias("rows"),
            F.min("ingested_at").cast("string").alias("oldest"),
            F.max("ingested_at").cast("string").alias("newest"),
        )
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(PARTITION, LOAD)
        .parquet(path)
    )
    found = seen.get
    zone = [F.lit(found[c]).cast(kind).alias(c) for c, kind in (f.split() for f in _ZONE.split(", "))]
    rows.sparkSession.range(0, 1, 1, 1).select(*zone).write.mode("overwrite").parquet(f"{_zones(path)}/{LOAD}={name}")
    return found["rows"]


def _zones(path: str) -> str:
    return f"{path.rstrip('/')}_loads"


def _listed(spark: SparkSession, path: str) -> list[str]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """One row per load: rows, oldest and newest ingestion time, load. A load lacks one if its
    writer died right after the rows, or if it was written by other means."""
    if not _listed(spark, _zones(path)):
        return spark.createDataFrame([], f"{_ZONE}, {LOAD} string")
    return spark.read.schema(f"{_ZONE}, {LOAD} string").parquet(_zones(path))


def _loads_before(spark: SparkSession, path: str, mark: Column, with_mark: bool) -> list[str]:
    """Loads of the mark's day or later whose newest row is before the mark (or at it); bounded by
    the loads of one day."""
    newest = F.col("newest")
    done = (newest >= F.to_date(mark).cast("timestamp_ntz")) & ((newest <= mark) if with_mark else (newest < mark))
    return [r[LOAD] for r in read_zones(spark, path).where(done).select(LOAD).collect()]


def read_raw(
    spark: SparkSession,
    path: str,
    schema: str,
    ingested_after: dt.datetime | str | None = None,
    ingested_from: dt.datetime | str | None = None,
) -> DataFrame:
    """The log, or its rows ingested after a mark (``ingested_from`` includes the mark).

    The mark also bounds the partition column, so older dates are not listed or read, and of its
    own date loads that end before it are left out by their zones, without opening a file.
    """
    rows = spark.read.schema(f"{schema}, {PARTITIONS}").parquet(path)
    at = F.col("ingested_at")
    for given, strictly in ((ingested_after, True), (ingested_from, False)):
        if given is not None:
            mark = utc_literal(given)
            rows = rows.where((F.col(PARTITION) >= F.to_date(mark)) & ((at > mark) if strictly else (at >= mark)))
            done = _loads_before(spark, path, mark, strictly)
            rows = rows.where(~F.col(LOAD).isin(*done)) if done else rows
    return rows.drop(PARTITION, LOAD)


def read_newest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows that hold the log's newest ``ingested_at``: the zones of its loads, or where a load of
    the newest date has none, the rows of that date."""
    dates = [n.partition("=")[2] for n in _listed(spark, path) if n.startswith(f"{PARTITION}=") and n[len(PARTITION) + 1].isdigit()]
    newest = max(dates, default=None)
    loads = {n.partition("=")[2] for n in _listed(spark, f"{path}/{PARTITION}={newest}")} if newest else set()
    if loads and loads <= {n.partition("=")[2] for n in _listed(spark, _zones(path))}:
        return read_zones(spark, path).select(F.col("newest").alias("ingested_at"))
    return read_raw(spark, path, schema, ingested_from=newest)
