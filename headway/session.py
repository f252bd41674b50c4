"""Spark session settings the jobs are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Every timestamp is a zone-free UTC wall clock; the session zone only decides how
    # zoned input is shown, and UTC keeps that readable.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Size of reducers after merging, and of the files a rebalanced write makes.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "32",
}


def build_session(
    app_name: str = "headway",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """Session for jobs, tests and the bench.

    On a cluster leave ``master`` unset and give ``shuffle_partitions`` high enough that
    one partition of the event-key shuffle stays near 200 MB (about 50,000 for 10 TB
    shuffled); AQE merges the small ones afterwards.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
