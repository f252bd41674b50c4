"""Hard negatives by a secondary-sort shuffle.

Scores of (anchor, row) pairs are shuffled by anchor and sorted inside it by falling score,
positives first at equal scores, then identifier (``repartition`` and
``sortWithinPartitions``, the DataFrame form of repartitionAndSortWithinPartitions). A
streaming iterator then reads each anchor's pairs once: a positive opens a window of scores,
a negative is emitted into every open window it falls into, and a window closes with its last
negative. It holds the open windows of one anchor, never the anchor's pairs.

Anchors are a stated set of rows, scored against all rows in cells: blocks of at most
``anchors_per_cell`` anchors times groups of rows. A cell's task holds its anchors and streams
its rows. Before the shuffle it keeps, per anchor, only what can be in the result: the first
positives of its rows, and per window their first negatives. What is dropped has enough better
pairs in the same cell, so the result is that of all pairs, while an anchor sends a bounded
number of pairs per cell. Positives are found first, as the windows follow from them. Rows are
dealt to cells by their number, so neither a label nor equal vectors make a cell larger.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.sources.scratch import new_folder, written

# Fixed value: entries become floor(STEPS * c).
STEPS = 256
# No score reaches this, so a score and a place in a batch fit one 64-bit number.
_MOST_SCORE = 2**46
_NONE = np.int64(-(2**62))
_CHUNK = 1 << 21  # scores computed at a time


class Options(NamedTuple):
    """A negative of positive score p has a score from ``low`` to ``high`` percent of p."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    rows_per_cell: int = 4096
    anchors_per_cell: int = 16384
    most_row_groups: int = 4096


def prepared(
    table: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(nr, id, label, x, is_anchor) of the rows that take part. ``nr`` numbers the rows, so
    that repeated identifiers stay apart; it holds only once written."""
    entries = F.col(vector_col).cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = table.select(
        F.col(id_col).cast("bigint").alias("id"),
        label.cast("bigint").alias("label"),
        F.transform(entries, lambda c: F.floor(c * STEPS)).alias("x"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        (finite & F.col(vector_col).isNotNull()).alias("usable"),
    )
    kept = rows.where(F.col("usable") & F.col("label").isNotNull()).drop("usable")
    return kept.select(F.monotonically_increasing_id().alias("nr"), "*")


# What a cell's task reads: its anchors first, each with the scores of its positives, then
# the rows in the order that settles ties.
_CELL = "cell", "kind", "id", "nr", "label", "x", "positives"


def _cells(rows: DataFrame, anchors: DataFrame, counts: tuple[int, int], options: Options) -> DataFrame:
    n_rows, n_anchors = counts
    groups = max(1, min(-(-n_rows // options.rows_per_cell), options.most_row_groups))
    blocks = max(1, -(-n_anchors // options.anchors_per_cell))
    group, block = (F.pmod(F.xxhash64("nr"), F.lit(n)) for n in (groups, blocks))
    every_group, every_block = (F.sequence(F.lit(0), F.lit(n - 1)) for n in (groups, blocks))
    # Anchors and rows meet in every cell of a grid: a stated query set against all rows.
    of_rows = rows.select(
        F.explode(F.transform(every_block, lambda b: group * blocks + b)).alias("cell"),
        F.lit(1).alias("kind"), "id", "nr", "label", "x", F.lit(None).cast("array<bigint>").alias("positives"),
    )
    of_anchors = anchors.select(
        F.explode(F.transform(every_group, lambda g: g * blocks + block)).alias("cell"),
        F.lit(0).alias("kind"), "id", "nr", "label", "x", "positives",
    )
    tasks = min(groups * blocks, 2 * options.most_row_groups)
    every = of_rows.unionByName(of_anchors).repartitionById(tasks, F.pmod("cell", F.lit(tasks)).cast("int"))
    return every.sortWithinPartitions("cell", "kind", F.asc_nulls_last("id"), "nr").select(*_CELL)


class _Batch(NamedTuple):
    ids: list
    nrs: np.ndarray
    labels: np.ndarray
    x: np.ndarray


def _vectors(column: pa.Array, size: int | None) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths != (lengths[0] if size is None else size)).any():
        raise ValueError("vectors need one length")
    return flat.reshape(len(column), -1 if len(flat) else 0)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Runs of one cell and one kind."""
    for batch in batches:
        if batch.num_rows:
            cell, kind = _numbers(batch.column(0)), _numbers(batch.column(1))
            edges = np.flatnonzero((np.diff(cell) != 0) | (np.diff(kind) != 0)) + 1
            for start, end in zip([0, *edges], [*edges, len(cell)]):
                yield int(cell[start]), int(kind[start]), batch.slice(start, end - start)


class _Anchors:
    """The anchors of a cell and, per anchor and slot, the best pairs seen so far.

    ``slots`` are the windows of an anchor, or the one list of its positives. Of equal scores
    the row that comes first in the cell's order is better, and rows stream in that order.
    """

    def __init__(self, parts: list[pa.RecordBatch], slots: int, depth: int):
        column = lambda i: pa.concat_arrays([p.column(i) for p in parts])
        self.nrs, self.labels = _numbers(column(3)), _numbers(column(4))
        self.ids = column(2)
        self.x = _vectors(column(5), None)
        self.most = int(np.abs(self.x).max(initial=0))
        self.positives = column(6).to_pylist()
        shape = len(self.nrs), slots, depth
        self.scores = np.full(shape, _NONE)
        self.row_nrs = np.zeros(shape, np.int64)
        self.row_ids = np.zeros(shape, np.int64)
        self.no_id = np.zeros(shape, bool)

    def score_type(self, x: np.ndarray):
        bound = self.most * int(np.abs(x).max(initial=0)) * x.shape[1]
        if bound >= _MOST_SCORE:
            raise ValueError("vectors are too long for exact scores")
        # Sums of whole numbers below these bounds are exact in floating point.
        return np.float32 if bound < 2**24 else np.float64

    def keys(self, batch: _Batch) -> Iterator[tuple[slice, np.ndarray]]:
        """Per chunk of anchors one number per pair: score, then the place from the end."""
        kind = self.score_type(batch.x)
        size = 1 << int(len(batch.nrs)).bit_length()
        right = batch.x.astype(kind).T
        places = size - 1 - np.arange(len(batch.nrs))
        step = max(1, _CHUNK // max(1, len(batch.nrs)))
        for start in range(0, len(self.nrs), step):
            part = slice(start, start + step)
            yield part, (self.x[part].astype(kind) @ right).astype(np.int64) * size + places

    def merge(self, part: slice, keys: np.ndarray, batch: _Batch) -> None:
        """Takes over the better of the held pairs and those of ``keys`` (anchor, slot, depth),
        best first; held ones come first at equal scores."""
        size = 1 << int(len(batch.nrs)).bit_length()
        empty = keys == _NONE
        places = np.where(empty, 0, size - 1 - keys % size)
        scores = np.where(empty, _NONE, keys // size)
        both = np.concatenate([self.scores[part], scores], axis=2)
        best = np.argsort(-both, axis=2, kind="stable")[:, :, : self.scores.shape[2]]
        take = lambda held, new: np.take_along_axis(np.concatenate([held[part], new], axis=2), best, axis=2)
        self.row_nrs[part] = take(self.row_nrs, batch.nrs[places])
        missing = np.array([i is None for i in batch.ids])
        ids = np.array([0 if i is None else i for i in batch.ids], dtype=np.int64)
        self.row_ids[part] = take(self.row_ids, ids[places])
        self.no_id[part] = take(self.no_id, missing[places])
        self.scores[part] = np.take_along_axis(both, best, axis=2)

    def found(self) -> Iterator[pa.RecordBatch]:
        """The distinct pairs held, as (anchor, anchor_id, score, id, nr)."""
        anchor, slot, depth = np.nonzero(self.scores > _NONE)
        where = anchor, slot, depth
        _, first = np.unique(np.stack([anchor, self.row_nrs[where]]), axis=1, return_index=True)
        if not len(first):
            return
        anchor, where = anchor[first], tuple(w[first] for w in where)
        columns = [
            pa.array(self.nrs[anchor]),
            self.ids.take(pa.array(anchor)),
            pa.array(self.scores[where]),
            pa.array(self.row_ids[where], mask=self.no_id[where]),
            pa.array(self.row_nrs[where]),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["anchor", "anchor_id", "score", "id", "nr"])


_FOUND = "anchor bigint, anchor_id bigint, score bigint, id bigint, nr bigint"


def _pairs(cells: DataFrame, slots: int, depth: int, choose: Callable[[_Anchors, _Batch], None]) -> DataFrame:
    """Runs over the cells; ``choose`` merges the pairs of a batch of rows into the anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, anchors = None, [], None
        for cell, kind, batch in _by_cell(batches):
            if cell != now:
                if anchors is not None:
                    yield from anchors.found()
                now, parts, anchors = cell, [], None
            if kind == 0:
                parts.append(batch)
            elif parts:
                anchors = anchors or _Anchors(parts, slots, depth)
                x = _vectors(batch.column(5), anchors.x.shape[1])
                choose(anchors, _Batch(batch.column(2).to_pylist(), _numbers(batch.column(3)), _numbers(batch.column(4)), x))
        if anchors is not None:
            yield from anchors.found()

    return cells.mapInArrow(run, _FOUND)


def _choose_positives(depth: int) -> Callable[[_Anchors, _Batch], None]:
    def choose(anchors: _Anchors, batch: _Batch) -> None:
        for part, keys in anchors.keys(batch):
            own = (anchors.labels[part][:, None] != batch.labels) | (anchors.nrs[part][:, None] == batch.nrs)
            keys[own] = _NONE
            width = min(depth, keys.shape[1])
            best = np.partition(keys, keys.shape[1] - width, axis=1)[:, -width:]
            anchors.merge(part, np.sort(best, axis=1)[:, ::-1][:, None, :], batch)

    return choose


def _choose_negatives(options: Options) -> Callable[[_Anchors, _Batch], None]:
    def choose(anchors: _Anchors, batch: _Batch) -> None:
        size = 1 << int(len(batch.nrs)).bit_length()
        depth = options.negatives
        for part, keys in anchors.keys(batch):
            keys[anchors.labels[part][:, None] == batch.labels] = _NONE
            keys.sort(axis=1)
            best = np.full((len(keys), options.positives, depth), _NONE)
            for row, (ordered, scores) in enumerate(zip(keys, anchors.positives[part])):
                lows = np.array([-(-s * options.low // 100) for s in scores])
                highs = np.array([s * options.high // 100 for s in scores])
                ends = np.searchsorted(ordered, (highs + 1) * size)
                for slot, (end, low) in enumerate(zip(ends, lows)):
                    top = ordered[max(0, end - depth) : end][::-1]
                    top = top[top >= low * size]
                    best[row, slot, : len(top)] = top
            anchors.merge(part, best, batch)

    return choose


def _in_order(pairs: DataFrame) -> DataFrame:
    """The secondary sort: anchors apart, and within one the best pair first."""
    return pairs.repartition("anchor").sortWithinPartitions(
        "anchor", F.desc("score"), "kind", F.asc_nulls_last("id"), "nr"
    )


_POSITIVES = "anchor bigint, rank int, id bigint, score bigint"


def _first_positives(count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rank = None, 0
        for batch in batches:
            out = []
            for anchor, score, i in zip(*(batch.column(c).to_pylist() for c in ("anchor", "score", "id"))):
                rank = rank + 1 if anchor == now else 1
                now = anchor
                if rank <= count:
                    out.append((anchor, rank, i, score))
            yield _batch(out, _POSITIVES)

    return run


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32()}
    fields = [f.split() for f in ddl.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


_MINED = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _open_windows(options: Options):
    """Reads pairs in falling order of scores; kind 0 is a positive, kind 1 a negative."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, windows = None, []
        for batch in batches:
            out = []
            columns = ("anchor", "anchor_id", "score", "kind", "id")
            for anchor, anchor_id, score, kind, i in zip(*(batch.column(c).to_pylist() for c in columns)):
                if anchor != now:
                    now, windows = anchor, []
                if kind == 0:
                    windows.append([i, score, 0])
                    continue
                windows = [w for w in windows if w[2] < options.negatives and 100 * score >= options.low * w[1]]
                for window in windows:
                    if 100 * score <= options.high * window[1]:
                        window[2] += 1
                        out.append((anchor_id, window[0], window[2], i, window[1], score))
            yield _batch(out, _MINED)

    return run


def mine(
    table: DataFrame,
    is_anchor: Column,
    label: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    options: Options = Options(),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    An entry c of a vector becomes floor(256 * c); a score is the whole-number inner product.
    Higher scores come first, of equal ones the smaller identifier (null last), then any fixed
    order of repeated rows. An anchor's positives are its first other rows of its label;
    for each, the first rows of another label whose score is within the window are returned.

    Rows whose label or vector is null, or whose vector holds a null or non-finite entry, take
    no part. A row without an identifier can be a positive or a negative. Repeated rows are rows
    of their own: a copy of an anchor is a positive of it and an anchor itself. Scores of 0 or
    less have windows too (only 0 can fill one). An empty table or one without anchors gives no
    rows. Vectors of several lengths, or with scores from 2^46 on, raise an error. Other
    columns are not read.
    """
    spark = table.sparkSession
    rows = written(prepared(table, is_anchor, label, id_col, vector_col), new_folder(spark, "vectors"))
    counted = rows.agg(F.count("*").alias("n"), F.count_if("is_anchor").alias("anchors")).first()
    counts = counted["n"], counted["anchors"]
    chosen = rows.where("is_anchor")
    bare = chosen.withColumn("positives", F.lit(None).cast("array<bigint>"))
    pairs = _pairs(_cells(rows, bare, counts, options), 1, options.positives, _choose_positives(options.positives))
    pairs = _in_order(pairs.withColumn("kind", F.lit(0)))
    positives = written(pairs.mapInArrow(_first_positives(options.positives), _POSITIVES), new_folder(spark, "positives"))

    # At most ``positives`` scores per anchor.
    scores = positives.groupBy("anchor").agg(F.collect_list("score").alias("positives"))
    anchors = chosen.join(scores, F.col("nr") == F.col("anchor")).drop("anchor")
    negatives = _pairs(
        _cells(rows, anchors, counts, options), options.positives, options.negatives, _choose_negatives(options)
    )
    ids = chosen.select(F.col("nr").alias("of"), F.col("id").alias("anchor_id"))
    openers = positives.join(ids, F.col("anchor") == F.col("of")).select(
        "anchor", "anchor_id", "score", "id", F.col("rank").cast("bigint").alias("nr"), F.lit(0).alias("kind")
    )
    both = openers.unionByName(negatives.withColumn("kind", F.lit(1)))
    return _in_order(both).mapInArrow(_open_windows(options), _MINED)
