"""Parquet table whose parts are replaced whole.

Plain parquet has no MERGE, and overwriting it in place breaks its readers. Here a row's part
is a day or a bucket of its key's hash. A write puts new content of some parts into a folder
of its own; a small pointer file then says for every part which folder holds it. Readers
follow the newest pointer. A pointer appears in one rename that fails if its number is taken,
so a failed write changes nothing and of two writers that start from one pointer the second
gets an error.

    <path>/data/v=3-1f0c.../part=17/part-*.parquet
    <path>/pointers/00000003.json
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from headway import schemas

PART = "part"
# Buckets of a table that is merged by key: so many that one holds some 100 MB.
BUCKETS = 8
_WHOLE = "all"
_NO_DAY = "none"


def by_day(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(_NO_DAY))


def by_hash(key: str, buckets: int = BUCKETS) -> Column:
    """The bucket of a key; a null key has one too."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string")


class Pointer(NamedTuple):
    """Where the content is: the folder of every part, and what its writer noted."""

    version: int
    parts: dict[str, str]
    notes: dict


class StoredTable:
    """``hidden`` columns are stored beside the schema's, for merges, and not shown to readers.
    ``part`` gives a row's part; without it the table is one part."""

    def __init__(self, spark: SparkSession, path: str, schema: str, part: Column | None = None, hidden: str = ""):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.part = F.lit(_WHOLE) if part is None else part
        self.hidden = hidden

    def _fs(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def _names(self, path: str) -> list[str]:
        fs, target = self._fs(path)
        if not fs.exists(target):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(target))

    def _delete(self, path: str) -> None:
        fs, target = self._fs(path)
        fs.delete(target, True)

    def _pointer_path(self, version: int) -> str:
        return f"{self.path}/pointers/{version:08d}.json"

    def versions(self) -> list[int]:
        return [int(name[:8]) for name in self._names(f"{self.path}/pointers") if name[0].isdigit()]

    def _text(self, version: int) -> str:
        fs, target = self._fs(self._pointer_path(version))
        stream = fs.open(target)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def pointer(self) -> Pointer:
        versions = self.versions()
        return Pointer(**json.loads(self._text(versions[-1]))) if versions else Pointer(0, {}, {})

    @property
    def mark(self) -> str | None:
        """Highest ingestion time held, as text; null while the table is empty."""
        return self.pointer().notes.get("mark")

    def read(self, parts: Iterable[str] | None = None, with_hidden: bool = False, at: Pointer | None = None) -> DataFrame:
        """The table, or some of its parts, as of now or of a pointer."""
        stored = f"{self.schema}, {self.hidden}" if self.hidden else self.schema
        shown = schemas.struct(stored if with_hidden else self.schema)
        held = (at or self.pointer()).parts
        wanted = sorted(held) if parts is None else sorted(set(parts) & set(held))
        if not wanted:
            return self.spark.createDataFrame([], shown)
        folders = [f"{self.path}/data/{held[part]}/{PART}={part}" for part in wanted]
        rows = self.spark.read.schema(stored).option("basePath", f"{self.path}/data").parquet(*folders)
        return rows.select(*shown.fieldNames())

    def new_folder(self, at: Pointer, kind: str = "v") -> str:
        """A folder below ``data`` that no other writer uses."""
        return f"{kind}={at.version + 1}-{uuid.uuid4().hex}"

    def written_parts(self, folder: str) -> list[str]:
        return [n[len(PART) + 1 :] for n in self._names(f"{self.path}/data/{folder}") if n.startswith(f"{PART}=")]

    def write_parts(
        self, rows: DataFrame, folder: str, part: Column | None = None, highest: dict[str, str] | None = None
    ) -> tuple[list[str], dict[str, str | None]]:
        """Writes rows below ``data`` without making them current; returns their parts and the
        maxima of the columns in ``highest``. The rebalance sizes files per part and splits a
        part too large for one task."""
        rows = rows.withColumn(PART, self.part if part is None else part).hint("rebalance", PART)
        seen = Observation()
        maxima = [F.max(column).cast("string").alias(name) for name, column in (highest or {}).items()]
        if maxima:
            rows = rows.observe(seen, *maxima)
        rows.write.partitionBy(PART).parquet(f"{self.path}/data/{folder}")
        return self.written_parts(folder), seen.get if maxima else {}

    def replace(
        self,
        rows: DataFrame,
        parts: Iterable[str] | None = None,
        at: Pointer | None = None,
        highest: dict[str, str] | None = None,
        **notes,
    ) -> Pointer:
        """Makes ``rows`` the content of the given parts, or of the whole table.

        ``at`` is the pointer the rows were derived from; if it is no longer the newest, the
        write is refused. A given part without rows leaves the table. ``highest`` notes the
        maximum of a column over the table under a name; ``notes`` replace notes of that name.
        """
        at = at or self.pointer()
        folder = self.new_folder(at)
        written, maxima = self.write_parts(rows, folder, highest=highest)
        noted = dict(at.notes)
        for name, value in maxima.items():
            before = [noted.get(name)] if parts is not None else []
            noted[name] = max(filter(None, [*before, value]), default=None)
        replaced = set(at.parts) if parts is None else set(parts)
        held = {part: f for part, f in at.parts.items() if part not in replaced}
        held.update({part: folder for part in written})
        new = Pointer(at.version + 1, held, {**noted, **notes})
        self._publish(new.version, json.dumps(new._asdict()))
        return new

    def _publish(self, version: int, text: str) -> None:
        """The pointer is written aside and then renamed, which fails if its number is taken."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        fs, aside = self._fs(f"{self.path}/pointers/_{uuid.uuid4().hex}")
        stream = fs.create(aside, False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        context = hadoop.FileContext.getFileContext(aside.toUri(), self.spark._jsc.hadoopConfiguration())
        never = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
        never[0] = getattr(hadoop, "Options$Rename").NONE
        try:
            context.rename(aside, self._fs(self._pointer_path(version))[1], never)
        except Py4JJavaError as e:
            fs.delete(aside, False)
            if "FileAlreadyExists" in str(e.java_exception):
                raise RuntimeError(f"{self.path}: version {version} was written by another writer") from e
            raise

    def drop_old(self, keep: int = 2) -> None:
        """Deletes all but the last ``keep`` pointers, and the folders none of those names.
        Folders of writers that have not finished yet are left alone."""
        versions = self.versions()
        kept = "".join(self._text(v) for v in versions[-keep:])
        for folder in self._names(f"{self.path}/data"):
            number = re.match(r"[a-z]+=(\d+)-", folder)
            if number and folder not in kept and int(number[1]) <= versions[-1]:
                self._delete(f"{self.path}/data/{folder}")
        for version in versions[:-keep]:
            self._delete(self._pointer_path(version))
