"""Exact duplicates by a tree-merge of sorted digest runs.

Every row gets a lane (its input partition, folded to a power of two). A lane's run holds
one entry per text digest, sorted by digest: the smallest identifier and the number of
rows. In each round groups of lanes whose numbers differ only in the next bits exchange
their runs and merge them, so after the last round one run is left. An aggregate whose
value is a struct runs as Spark's sort aggregate: it sorts by (lane, digest) and merges
neighbouring entries, on the map side first, so a text with a third of all rows enters a
round as one entry per lane and task. Results go back by lane and digest, which spreads
such a text over all lanes.

Entries merge only where a 64-bit digest and the SHA-256 of the whole normalised text both
agree; the second verifies the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.text import SPACES, packed, whole
from headway.sources.scratch import new_folder, written


def normalised(text: Column) -> Column:
    """Each run of white space as one space."""
    return F.regexp_replace(text, SPACES, " ")


def _digest_rows(docs: DataFrame, id_col: str, text_col: str, lanes: int, with_rows: bool) -> DataFrame:
    flat = normalised(whole(text_col))
    key = F.col(id_col)
    rows = packed(docs, key=key, flat=flat) if with_rows else docs.select(key.alias("key"), flat.alias("flat"))
    return rows.select(
        *(["row"] if with_rows else []),
        "key",
        # Row numbers tell repeated rows apart; they are written before they are used.
        F.monotonically_increasing_id().alias("nr"),
        F.pmod(F.spark_partition_id(), F.lit(lanes)).cast("int").alias("lane"),
        F.xxhash64("flat").alias("digest"),
        F.unhex(F.sha2("flat", 256)).alias("sha"),
    )


def merge_runs(entries: DataFrame, lane_bits: int, round_bits: int) -> DataFrame:
    """One entry per digest from entries of (lane, digest, sha, first, copies)."""
    done = 0
    while done < lane_bits:
        step = min(round_bits, lane_bits - done)
        lane = F.shiftright("lane", step).alias("lane")
        entries = entries.groupBy(lane, "digest", "sha").agg(
            F.min("first").alias("first"), F.sum("copies").alias("copies")
        )
        done += step
    return entries.drop("lane")


def group_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lane_bits: int = 6,
    round_bits: int = 2,
    with_rows: bool = False,
) -> DataFrame:
    """Every row with its group: key, keep_key, copies, kept, sha (and ``row`` if asked).

    Texts are equal when they are identical after each run of white space became one space;
    a null text counts as empty. The row with the smallest identifier is kept, rows without
    one come last, and of repeated rows with that identifier exactly one is kept. An empty
    table gives no rows; other columns are never looked at.
    """
    spark = docs.sparkSession
    table = _digest_rows(docs, id_col, text_col, 1 << lane_bits, with_rows)
    table = written(table, new_folder(spark, "digests"))
    order = F.struct(F.col("key").isNull().alias("missing"), F.col("key"), F.col("nr"))
    runs = table.groupBy("lane", "digest", "sha").agg(F.min(order).alias("first"), F.count("*").alias("copies"))
    runs = written(runs, new_folder(spark, "runs"))
    merged = merge_runs(runs, lane_bits, round_bits)
    by_lane = runs.select("lane", "digest", "sha").join(merged, ["digest", "sha"])
    return table.join(by_lane, ["lane", "digest", "sha"]).select(
        *(["row"] if with_rows else []),
        "key",
        F.col("first.key").alias("keep_key"),
        "copies",
        (F.col("nr") == F.col("first.nr")).alias("kept"),
        "sha",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept rows, with the columns they came with."""
    return group_copies(docs, id_col, text_col, with_rows=True).where("kept").select("row.*")
