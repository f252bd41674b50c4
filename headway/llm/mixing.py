"""Mixing sources to target weights by Pfair scheduling.

Documents of a source form blocks. With weight ``w`` (its share of all weights) block ``j``
(from 1) of a source is released at slot ``floor((j - 1) / w)`` and due at slot
``ceil(j / w)``; slot after slot the released block with the earliest deadline is taken.
Weights are exact fractions, so before every slot each source has received less than one
block more or less than its target share, however long the mix.

A source that has run out leaves the schedule; the others share its slots in proportion from
then on (a new phase). So every document gets exactly one position, and up to the end of a
phase all its sources keep their target weights.

A slot depends on those before it, so one task computes the schedule of the blocks, in
memory that grows with the sources alone; it streams to a table that the documents then
meet by source and block. Only the number of documents per source passes through the driver.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping
from fractions import Fraction
from itertools import islice
from math import lcm

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.sources.scratch import new_folder, written

MAX_SOURCES = 10_000
_BATCH = 100_000


def whole_ratios(weights: Mapping[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the ratio of the weights."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    unit = lcm(*(w.denominator for w in exact.values()))
    return {s: int(w * unit) for s, w in exact.items()}


def schedule(blocks: Mapping[str, int], weights: Mapping[str, float]) -> Iterator[tuple[str, int, int, int]]:
    """(source, block, phase, slot) of every block, slot after slot, by earliest deadline
    among released blocks; ties go to the smaller name.

    A phase ends with the slot in which a source's last block is placed.
    """
    ratios = whole_ratios({s: weights[s] for s, n in blocks.items() if n > 0})
    used = dict.fromkeys(ratios, 0)
    slot = phase = 0
    while ratios:
        total = sum(ratios.values())
        start, first = slot, dict(used)
        waiting = [(0, s) for s in sorted(ratios)]
        ready: list[tuple[int, str]] = []
        while True:
            while waiting and waiting[0][0] <= slot - start:
                _, s = heapq.heappop(waiting)
                heapq.heappush(ready, (-(-(used[s] - first[s] + 1) * total // ratios[s]), s))
            _, s = heapq.heappop(ready)
            yield s, used[s], phase, slot
            slot += 1
            used[s] += 1
            if used[s] == blocks[s]:
                break
            heapq.heappush(waiting, ((used[s] - first[s]) * total // ratios[s], s))
        del ratios[s]
        phase += 1


_PLACES = "at_source string, at_block bigint, phase int, slot bigint"


def _schedule_table(spark: SparkSession, blocks: Mapping[str, int], weights: Mapping[str, float]) -> DataFrame:
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.string(), pa.int64(), pa.int32(), pa.int64())
        names = ["at_source", "at_block", "phase", "slot"]
        for _one_row in rows:
            places = schedule(blocks, weights)
            while part := list(islice(places, _BATCH)):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types)], names=names)

    return written(spark.range(0, 1, 1, 1).mapInArrow(run, _PLACES), new_folder(spark, "schedule"))


def _numbered(rows: DataFrame, lots: int) -> DataFrame:
    """Adds ``index``: the number of a row within its source, without one task per source.

    Rows of a source are dealt into ``lots`` by a hash of their identifier and numbered per
    lot; a lot starts after the rows of the lots before it.
    """
    lot = F.pmod(F.xxhash64("id", "source"), F.lit(lots)).cast("int")
    rows = rows.withColumn("lot", lot)
    sizes = rows.groupBy("source", "lot").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("source").alias("s"), F.col("lot").alias("l"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("source", "lot").orderBy(F.xxhash64(F.lit(1), "id"), "id")
    rows = rows.withColumn("within", F.row_number().over(within) - 1)
    return rows.join(starts, (F.col("source") == F.col("s")) & (F.col("lot") == F.col("l"))).select(
        *(c for c in rows.columns if c not in ("lot", "within")), (F.col("offset") + F.col("within")).alias("index")
    )


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    block_size: int = 16,
    temperature: float = 0.5,
    rows_per_lot: int = 100_000,
    with_rows: bool = False,
) -> DataFrame:
    """Every row with its place in the mix: id, source, index, block, phase, slot, position.

    ``weights`` are target weights per source; a source they lack gets the smallest of them.
    Without weights a source weighs its number of documents to the power ``temperature``.
    ``position`` numbers all rows from 0 without gaps inside a block; the last block of a
    source may be short. Rows without a source form the source ''. Repeated rows and ties
    are separate rows with separate positions; a null identifier is ordered like any other.
    An empty table gives no rows. ``with_rows`` keeps the row as ``row``, so that other
    columns cannot clash. More than ``MAX_SOURCES`` sources raise an error.
    """
    spark = docs.sparkSession
    source = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    key = F.col(id_col).cast("string")
    rows = docs.select(*([F.struct("*").alias("row")] if with_rows else []), F.col(id_col).alias("id"), source.alias("source"))
    counts = {
        r["source"]: r["n"]
        for r in docs.groupBy(source.alias("source")).agg(F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    }
    if len(counts) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    if weights is None:
        chosen = {s: float(n) ** temperature for s, n in counts.items()}
    else:
        chosen = {s: float(weights.get(s, min(weights.values()))) for s in counts}
    if any(w <= 0 for w in chosen.values()):
        raise ValueError("weights must be positive")
    places = _schedule_table(spark, {s: -(-n // block_size) for s, n in counts.items()}, chosen)
    lots = max(512, -(-max(counts.values(), default=0) // rows_per_lot))
    rows = _numbered(rows, lots).withColumn("block", F.floor(F.col("index") / block_size))
    placed = rows.join(places, (F.col("source") == F.col("at_source")) & (F.col("block") == F.col("at_block")))
    return placed.select(
        *(["row"] if with_rows else []),
        "id",
        "source",
        "index",
        "block",
        "phase",
        "slot",
        (F.col("slot") * block_size + F.pmod("index", F.lit(block_size))).cast("bigint").alias("position"),
    )


def in_mixed_order(docs: DataFrame, **options) -> DataFrame:
    """The rows, with the columns they came with, sorted into the mix: files written from
    the result follow each other in its order."""
    return mix(docs, with_rows=True, **options).orderBy("position").select("row.*")
