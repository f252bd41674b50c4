"""Main text of pages by differencing each with its nearest page on the same host.

Pages are range-partitioned and sorted by host, path and identifier, so a page's nearest URL
is next to it and a host with a third of all pages spreads over many tasks. Neighbours with
the same lines form one group, however many; of the groups around it that are no copies, the
one that shares the longest path start is a page's partner (the nearer, then the earlier at a
tie). Both pages' text lines are aligned by longest common subsequence and the shared lines,
which belong to the site and not to the page, are deleted.

A task also gets the pages next to its borders: a first pass over digests of the pages' lines
finds the groups at the borders of every task, and the first and last page of each are sent
to the tasks beside it too. So results do not depend on the number of tasks.

Markup that says what a line is decides over chance: lines of menus, adverts, notices, forms
and comments go although no partner shares them, and lines of an article element stay
although a partner shares them, where marked lines hold half of the text at least (a smaller
article is a teaser). A page that shares nearly all of the text outside menus and the like is
a copy, whose alignment says nothing; where there are only copies, or no other page, the
marked lines stay if they hold half of the text, else all.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict, deque
from collections.abc import Iterable, Iterator
from itertools import groupby
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from headway.llm.html import Block, blocks
from headway.llm.url_filter import host_of, path_of
from headway.sources.scratch import new_folder, written

_COPY = 0.8
_NEAR = 4


def _prefix_lengths(a: list, b: list) -> list[int]:
    """Length of the longest common subsequence of ``a`` and every start of ``b``.

    Bit j of a whole number stands for b[j]; one addition per element of ``a`` does a row.
    """
    places: dict = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    masks = {x: sum(1 << j for j in js) for x, js in places.items()}
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        mask = masks.get(x)
        if mask:
            hit = row & mask
            row = ((row + hit) | (row - hit)) & full
    lengths = [0]
    for bit in reversed(f"{row:0{len(b)}b}" if b else ""):
        lengths.append(lengths[-1] + (bit == "0"))
    return lengths


def common_places(a: list, b: list) -> list[int]:
    """Places of ``a`` on a longest common subsequence with ``b``; memory is linear.

    Work is split at the middle of ``a`` where both halves' lengths add up to the most.
    """
    in_b, in_a = set(b), set(a)
    kept = [i for i, x in enumerate(a) if x in in_b]
    return [kept[i] for i in _aligned([a[i] for i in kept], [x for x in b if x in in_a])]


def _aligned(a: list, b: list) -> list[int]:
    found: list[int] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append(a0)
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append(a1)
        if a0 == a1 or b0 == b1:
            continue
        if a1 - a0 == 1:
            if a[a0] in b[b0:b1]:
                found.append(a0)
            continue
        middle = (a0 + a1) // 2
        first = _prefix_lengths(a[a0:middle], b[b0:b1])
        second = _prefix_lengths(a[middle:a1][::-1], b[b0:b1][::-1])[::-1]
        cut = max(range(len(first)), key=lambda j: first[j] + second[j])
        work += [(a0, middle, b0, b0 + cut), (middle, a1, b0 + cut, b1)]
    return sorted(found)


class Page(NamedTuple):
    key: object
    url: str | None
    host: str
    path: str
    lines: list[Block]
    lent: bool = False  # belongs to a task beside this one


def _shared_start(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a.split("/"), b.split("/")):
        if x != y:
            break
        n += 1
    return n


class Group(NamedTuple):
    """Neighbours on one host with the same lines."""

    pages: list[Page]  # without their lines
    lines: list[Block]


def groups(pages: Iterable[Page]) -> Iterator[Group]:
    group = None
    for page in pages:
        bare = page._replace(lines=[])
        if group is not None and group.pages[0].host == page.host and group.lines == page.lines:
            group.pages.append(bare)
        else:
            if group is not None:
                yield group
            group = Group([bare], page.lines)
    if group is not None:
        yield group


def _with_near(found: Iterable[Group]) -> Iterator[tuple[Group, list[Group]]]:
    """Every group and those of its host among ``_NEAR`` before and after it, the nearest first."""
    before: deque[Group] = deque(maxlen=_NEAR)
    ahead: deque[Group] = deque()
    found = iter(found)
    while True:
        while len(ahead) <= _NEAR and (following := next(found, None)) is not None:
            ahead.append(following)
        if not ahead:
            return
        group = ahead.popleft()
        sides = [list(before)[::-1], list(ahead)]
        near = [side[i] for i in range(_NEAR) for side in sides if i < len(side)]
        yield group, [g for g in near if g.pages[0].host == group.pages[0].host]
        before.append(group)


def texts(pages: Iterable[Page]) -> Iterator[tuple[Page, str]]:
    """Every page, without its lines, and its main text."""
    for group, near in _with_near(groups(pages)):
        shared: dict[int, set[int] | None] = {}
        done: dict[int | None, str] = {}
        for page in group.pages:
            # Of a group's paths the first or the last is the nearest.
            likeness = [-max(_shared_start(page.path, g.pages[i].path) for i in (0, -1)) for g in near]
            partner = None
            for at in sorted(range(len(near)), key=lambda i: (likeness[i], i)):
                if at not in shared:
                    shared[at] = shared_lines(group.lines, near[at].lines)
                if shared[at] is not None:
                    partner = at
                    break
            if partner not in done:
                done[partner] = main_text(group.lines, None if partner is None else shared[partner])
            yield page, done[partner]


def shared_lines(lines: list[Block], partner: list[Block]) -> set[int] | None:
    """Places of lines that a partner shares; None if it is a copy of the page."""
    places = common_places([b.text for b in lines], [b.text for b in partner])
    own = sum(len(b.text) for b in lines if not b.around)
    shared = sum(len(lines[i].text) for i in places if not lines[i].around)
    return None if shared > _COPY * own else set(places)


def main_text(lines: list[Block], shared: set[int] | None) -> str:
    """``shared``: places of lines that the partner has too, None without a partner."""
    own = [b for b in lines if not b.around]
    marked = 0 < sum(len(b.text) for b in own) <= 2 * sum(len(b.text) for b in own if b.inside)
    if shared is None:
        return " ".join(b.text for b in own if b.inside or not marked)
    return " ".join(
        b.text for i, b in enumerate(lines) if not b.around and (i not in shared or (b.article and marked))
    )


class Run(NamedTuple):
    """Neighbours in one task with the same lines, by the keys of the first and the last."""

    host: str
    digest: bytes
    first: tuple
    last: tuple


def _digest(lines: list[Block]) -> bytes:
    return hashlib.blake2b("".join(f"{len(b.text)}:{b.text}{b[1:]}" for b in lines).encode("utf-8", "replace"), digest_size=16).digest()


def lent_pages(tasks: list[tuple[list[Run], list[Run]]]) -> dict[tuple, list[int]]:
    """Keys of pages that other tasks need, with those tasks' numbers.

    ``tasks`` holds the first and the last ``_NEAR + 1`` runs of every task in order. Runs that
    go on across a border are one group. A task needs the group at its border, if it goes on
    there, and ``_NEAR`` more on the same host; of each the first and the last page.
    """
    needed = defaultdict(list)
    for i, (head, tail) in enumerate(tasks):
        before = (run for j in range(i - 1, -1, -1) for run in reversed(tasks[j][1]))
        after = (run for j in range(i + 1, len(tasks)) for run in tasks[j][0])
        for border, following in ((head[0], before), (tail[-1], after)):
            found: list[list[tuple]] = []
            at = border
            for run in following:
                if run.host != border.host:
                    break
                if found and run[:2] == at[:2]:
                    found[-1] = [min(found[-1][0], run.first, key=_rank), max(found[-1][1], run.last, key=_rank)]
                elif len(found) > _NEAR:
                    break
                else:
                    found.append([run.first, run.last])
                at = run
            for key in {key for group in found for key in group}:
                needed[key].append(i)
    return needed


def _rank(key: tuple) -> tuple:
    """Order of keys as Spark sorts them: nulls first."""
    return tuple((v is not None, v) for v in key)


def _ends_of_tasks(keyed: DataFrame, tasks: int, order: list[str]) -> list[tuple[list[Run], list[Run]]]:
    """First and last runs of every task that a range partitioning by ``order`` makes.

    ``keyed`` has the columns of ``order`` and ``digest``. At most ``2 * (_NEAR + 1)`` rows a
    task reach the driver.
    """
    key = keyed.select(*order).schema
    at = "struct<" + ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in key) + ">"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: list[list] = []
        tail: deque[list] = deque(maxlen=_NEAR + 1)
        types = None
        n = 0
        for batch in batches:
            types = pa.struct([pa.field(c, batch.schema.field(c).type) for c in order])
            for row in batch.to_pylist():
                found = {c: row[c] for c in order}
                if tail and tail[-1][2]["host"] == row["host"] and tail[-1][1] == row["digest"]:
                    tail[-1][3] = found
                    continue
                tail.append([n, row["digest"], found, found])
                if len(head) <= _NEAR:
                    head.append(tail[-1])
                n += 1
        if n:
            rows = [(h, *r) for h, runs in ((True, head), (False, tail)) for r in runs]
            is_head, places, digests, firsts, lasts = zip(*rows)
            part = TaskContext.get().partitionId()
            columns = [pa.array([part] * len(rows), pa.int32()), pa.array(is_head), pa.array(places, pa.int64())]
            columns += [pa.array(digests, pa.binary()), pa.array(firsts, types), pa.array(lasts, types)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "head", "place", "digest", "first", "last"])

    schema = f"part int, head boolean, place bigint, digest binary, first {at}, last {at}"
    ranged = keyed.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    rows = sorted(ranged.mapInArrow(run, schema).collect(), key=lambda r: (r["part"], r["place"]))
    ends = []
    for _, own in groupby(rows, key=lambda r: r["part"]):
        sides: tuple[list[Run], list[Run]] = ([], [])
        for r in own:
            sides[0 if r["head"] else 1].append(Run(r["first"]["host"], bytes(r["digest"]), tuple(r["first"]), tuple(r["last"])))
        ends.append(sides)
    return ends


def _with_tasks(rows: DataFrame, ends: list[tuple[list[Run], list[Run]]], order: list[str]) -> DataFrame:
    """Adds ``part``, the number of the task that a row is for, and ``lent``; rows that other
    tasks need too come once for each."""
    types = {f.name: f.dataType for f in rows.select(*order).schema}

    def struct(key: tuple) -> Column:
        return F.struct(*(F.lit(v).cast(types[c]).alias(c) for c, v in zip(order, key)))

    starts = [struct(head[0].first) for head, _ in ends[1:]]
    own = F.struct(*(F.col(c) for c in order))
    part = F.size(F.filter(F.array(*starts), lambda s: s <= own)) if starts else F.lit(0)
    rows = rows.withColumn("part", part)
    lent = [(*key, parts) for key, parts in lent_pages(ends).items()]
    schema = rows.select(*order).schema.add("parts", ArrayType(IntegerType()))
    lent_rows = rows.sparkSession.createDataFrame(lent, schema).select(F.struct(*order).alias("lent_key"), "parts")
    rows = rows.join(F.broadcast(lent_rows), own.eqNullSafe(F.col("lent_key")), "left")
    sent = F.array(F.struct("part", F.lit(False).alias("lent")))
    more = F.transform(F.coalesce("parts", F.array().cast("array<int>")), lambda p: F.struct(p.alias("part"), F.lit(True).alias("lent")))
    kept = [c for c in rows.columns if c not in ("part", "parts", "lent_key")]
    return rows.select(*kept, F.explode(F.concat(sent, more)).alias("to")).select("to.part", "to.lent", *kept)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(id, url, text) per row.

    A null or empty page has an empty text, a null url an empty host and path like any url
    without '://'. Pages without a partner keep all lines that markup does not rule out.
    Repeated rows are pages of their own (and copies of each other); pages with the same url
    and identifier are ordered by a hash of their source; pages of any length are read whole;
    an empty table gives no rows; other columns are not looked at.
    """
    spark = pages.sparkSession
    url = F.col(url_col).cast("string")
    known = F.coalesce(url, F.lit(""))
    source = F.col(html_col).cast("string")
    rows = pages.select(
        host_of(known).alias("host"),
        path_of(known).alias("path"),
        F.col(id_col).alias("id"),
        F.xxhash64(source).alias("mark"),
        url.alias("url"),
        source.alias("html"),
    )
    order = ["host", "path", "id", "mark"]
    kind = rows.schema["id"].dataType.simpleString()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_digest(blocks(source.as_py() or "")) for source in batch.column(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(found, pa.binary())], names=[*order, "digest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_type = None

        def found() -> Iterator[tuple[int, Page]]:
            nonlocal key_type
            for batch in batches:
                key_type = batch.schema.field("id").type
                names = ("part", "lent", "id", "url", "host", "path", "html")
                for values in zip(*(batch.column(n) for n in names)):
                    part, lent, key, url, host, path, source = (v.as_py() for v in values)
                    yield part, Page(key, url, host, path, blocks(source or ""), lent)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            keys, urls, texts = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, key_type), pa.array(urls, pa.string()), pa.array(texts, pa.string())],
                names=["id", "url", "text"],
            )

        done: list[tuple] = []
        size = 0
        for _, own in groupby(found(), key=lambda pair: pair[0]):
            for page, text in texts(page for _, page in own):
                if page.lent:
                    continue
                done.append((page.key, page.url, text))
                size += len(text)
                if size > 4 << 20 or len(done) >= 1000:
                    yield batch_of(done)
                    done, size = [], 0
        if done:
            yield batch_of(done)

    schema = f"host string, path string, id {kind}, mark bigint, digest binary"
    keyed = rows.select(*order, "html").mapInArrow(digests, schema)
    keyed = written(keyed, new_folder(spark, "lines"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())
    ends = _ends_of_tasks(keyed, tasks, order)
    result = f"id {kind}, url string, text string"
    if not ends:
        return spark.createDataFrame([], result)
    sent = _with_tasks(rows, ends, order).repartitionById(len(ends), F.col("part"))
    return sent.sortWithinPartitions("part", *order).mapInArrow(run, result)
