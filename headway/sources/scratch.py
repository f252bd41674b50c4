"""Shared folder for intermediate tables and stream checkpoints."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
# Deletes the shuffle files of a write when it ends, not when the driver next collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; a local session without one gets a temporary folder."""
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="headway-")
    spark.conf.set(_SETTING, folder)
    return folder


_made: list[tuple[SparkSession, str]] = []
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A folder of its own below the shared one, deleted when the program ends."""
    if not _made:
        atexit.register(drop_folders)
    folder = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    _made.append((spark, folder))
    if (passing := _passing.get()) is not None:
        passing.append(folder)
    return folder


@contextmanager
def passing_folders(spark: SparkSession) -> Iterator[None]:
    """Deletes the folders made inside (by this thread) at the end; what is to stay is written to
    a folder made before."""
    folders: list[str] = []
    outer = _passing.set(folders)
    try:
        yield
    finally:
        _passing.reset(outer)
        for folder in folders:
            drop_folder(spark, folder)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a scratch folder before the program ends, once nothing reads it any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    _made[:] = [made for made in _made if made[1] != folder]


def drop_folders() -> None:
    """Deletes the folders made so far; what still reads from them must be done."""
    while _made:
        spark, folder = _made.pop()
        if spark.sparkContext._jsc is not None:  # a stopped session deletes nothing
            drop_folder(spark, folder)


def written(df: DataFrame, path: str) -> DataFrame:
    """Writes once and reads back: lineage is cut, sizes are known to the planner, and a lost
    executor costs nothing already written. The shuffle files go with the write."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP)
    conf.set(_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)
