"""WARC records: reading files, deriving metadata and plain text from responses, writing.

Every response yields a metadata record and, where its content is text, a conversion record.
Both name the response in WARC-Refers-To (with its target and date), keep the HTTP headers
and digests of the source as fields of the metadata, and name each other. Identifiers are
derived from the source's identifier, so a repeated job or a lost executor gives the same
records again.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from email.message import Message
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.html import blocks

VERSION = "WARC/1.1"
_LINE = "\r\n"
_BETWEEN = "\r\n\r\n"
_PIECE = 1 << 14
_TITLE = re.compile(r"(?is)<title[^>]*>(.*?)(?:</title|\Z)")
_LANG = re.compile(r"""(?is)<html[^>]*\blang\s*=\s*["']?([\w-]+)""")
_LINK = re.compile(r"""(?is)<a\s[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")

RECORD = (
    "record_id string, type string, refers_to string, target_uri string, date string, content_type string,"
    " content_length bigint, block_digest string, payload_digest string, linked_record string, block string"
)
SOURCE = "record_id string, type string, target_uri string, date string, headers map<string, string>, block binary"


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def derived_id(source_id: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} of {source_id}')}>"


def responses(pages: DataFrame, date: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Response records of fetched pages, in the columns of ``SOURCE``.

    A null page is an empty body and a null url an empty target; repeated rows repeat their
    record, identifier included.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    key = F.sha1(F.concat_ws("\n", F.coalesce(F.col(id_col).cast("string"), F.lit("")), url))
    spread = [F.substring(key, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_LINE}Content-Type: text/html; charset=utf-8{_LINE}Content-Length: "),
        F.octet_length(html).cast("string"),
        F.lit(_BETWEEN),
    )
    return pages.select(
        F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *spread), F.lit(">")).alias("record_id"),
        F.lit("response").alias("type"),
        url.alias("target_uri"),
        F.lit(date).alias("date"),
        F.create_map(F.lit("Content-Type"), F.lit("application/http; msgtype=response")).alias("headers"),
        F.concat(head, html).cast("binary").alias("block"),
    )


def _http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and body of an HTTP response; without a header all is body."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    head, _, body = block.partition(b"\r\n\r\n")
    status, *lines = head.decode("latin-1").split(_LINE)
    return status, [(n.strip(), v.strip()) for n, _, v in (line.partition(":") for line in lines) if n], body


@lru_cache(maxsize=1024)
def _kind_of(content_type: str) -> tuple[str, str]:
    """Media type and character set of a Content-Type header."""
    message = Message()
    message["Content-Type"] = content_type or "text/html"
    return message.get_content_type(), message.get_content_charset() or "utf-8"


def _source_of(body: bytes, content_type: str) -> tuple[str, str] | None:
    """Media type and decoded body; None for content that is not text."""
    kind, charset = _kind_of(content_type)
    if kind not in ("text/html", "application/xhtml+xml", "text/plain"):
        return None
    try:
        return kind, body.decode(charset, "replace")
    except LookupError:
        return kind, body.decode("utf-8", "replace")


def _one_line(text: str) -> str:
    return " ".join(text.split())


def derive_one(record_id: str, target: str, date: str, headers: dict[str, str], block: bytes) -> Iterator[tuple]:
    """The metadata and, for text, the conversion of one response, as ``RECORD`` tuples."""
    status, http, body = _http(block)
    content_type = next((v for n, v in http if n.lower() == "content-type"), "")
    found = _source_of(body, content_type)
    metadata_id, conversion_id = derived_id(record_id, "metadata"), derived_id(record_id, "conversion")
    payload = digest(body)
    fields = [
        ("source-block-digest", digest(block)),
        ("source-payload-digest", payload),
        ("source-payload-length", str(len(body))),
        *((f"source-{n}", v) for n, v in sorted(headers.items())),
        *([("http-status", status)] if status else []),
        *((f"http-{n}", v) for n, v in http),
    ]
    if found is not None:
        kind, source = found
        # One line per block.
        text = source if kind == "text/plain" else "\n".join(b.text for b in blocks(source))
        data = text.encode()
        own = digest(data)
        title, lang = _TITLE.search(source), _LANG.search(source)
        fields += [("title", _one_line(unescape(title[1])))] if title else []
        fields += [("language", lang[1])] if lang else []
        fields += [("outlink", _one_line("".join(m))) for m in _LINK.findall(source)]
        fields += [("conversion-record", conversion_id), ("conversion-block-digest", own)]
    described = "".join(f"{n}: {_one_line(v)}{_LINE}" for n, v in fields)
    described_data = described.encode()
    yield (
        metadata_id, "metadata", record_id, target, date, "application/warc-fields",
        len(described_data), digest(described_data), None, conversion_id if found is not None else None, described,
    )
    if found is not None:
        yield (
            conversion_id, "conversion", record_id, target, date, "text/plain; charset=utf-8",
            len(data), own, own, metadata_id, text,
        )


def derive(records: DataFrame) -> DataFrame:
    """Metadata and conversion records (columns of ``RECORD``) of the responses in ``records``.

    Records of other types are passed over. A null block is an empty one, whose conversion is
    empty; null headers are none; a record without identifier gets derived ones from its
    target. Repeated rows repeat their records; an empty table gives none; columns beyond
    ``SOURCE`` are not looked at. Every record is read whole, one at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.strip().split(" ")[0] for f in RECORD.split(", ")]
        types = [pa.int64() if n == "content_length" else pa.string() for n in names]
        schema = pa.schema(list(zip(names, types)))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema=schema)

        for batch in batches:
            rows, size = [], 0
            for values in zip(*(batch.column(i) for i in range(5))):
                key, target, date, headers, block = (v.as_py() for v in values)
                found = derive_one(key or target or "", target or "", date or "", dict(headers or {}), block or b"")
                for row in found:
                    rows.append(row)
                    size += len(row[-1])
                if size > 4 << 20:
                    yield batch_of(rows)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows)

    source = records.where(F.col("type") == "response").select("record_id", "target_uri", "date", "headers", "block")
    return source.mapInArrow(run, RECORD)


def write_records(records: DataFrame, path: str) -> None:
    """Writes derived records as gzipped WARC files below ``path``, through Spark's committer.

    A record ends with two line ends, which are the writer's line separator.
    """
    optional = lambda name, column: F.when(column.isNotNull(), F.concat(F.lit(f"{name}: "), column, F.lit(_LINE))).otherwise("")
    head = F.concat(
        F.lit(f"{VERSION}{_LINE}WARC-Type: "), "type",
        F.lit(f"{_LINE}WARC-Record-ID: "), "record_id", F.lit(_LINE),
        optional("WARC-Date", F.col("date")),
        optional("WARC-Target-URI", F.col("target_uri")),
        optional("WARC-Refers-To", F.col("refers_to")),
        optional("WARC-Refers-To-Target-URI", F.col("target_uri")),
        optional("WARC-Refers-To-Date", F.col("date")),
        optional("WARC-Concurrent-To", F.col("linked_record")),
        optional("WARC-Block-Digest", F.col("block_digest")),
        optional("WARC-Payload-Digest", F.col("payload_digest")),
        optional("Content-Type", F.col("content_type")),
        F.lit("Content-Length: "), F.col("content_length").cast("string"), F.lit(_BETWEEN),
    )
    writer = records.select(F.concat(head, "block").alias("value")).write
    writer.option("lineSep", _BETWEEN).option("compression", "gzip").text(path)


def _inflated(data: memoryview, name: str) -> Iterator[bytes]:
    """Content of a gzipped file of any number of members, piece by piece."""
    at = 0
    while at < len(data):
        if data[at] == 0:  # padding after a member
            at += 1
            continue
        member = zlib.decompressobj(zlib.MAX_WBITS | 16)
        while not member.eof:
            if at >= len(data):
                raise ValueError(f"{name}: compressed data is cut off")
            piece = data[at : at + _PIECE]
            yield member.decompress(piece)
            at += len(piece) - len(member.unused_data)


def _pieces(data: memoryview) -> Iterator[bytes]:
    for at in range(0, len(data), _PIECE):
        yield bytes(data[at : at + _PIECE])


class _Feed:
    """Bytes that come in pieces, read front to back; what was read is let go."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held, self.at, self.passed = pieces, bytearray(), 0, 0

    def more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        if self.at > len(self.held) // 2:
            self.passed += self.at
            del self.held[: self.at]
            self.at = 0
        self.held += piece
        return True

    def has(self, n: int) -> bool:
        while len(self.held) - self.at < n:
            if not self.more():
                return False
        return True

    def take(self, n: int) -> bytes | None:
        if not self.has(n):
            return None
        self.at += n
        return bytes(self.held[self.at - n : self.at])

    def take_to(self, end: bytes) -> bytes | None:
        """What lies before ``end``, which is passed over too."""
        seen = 0
        while (found := self.held.find(end, self.at + seen)) < 0:
            seen = max(0, len(self.held) - self.at - len(end) + 1)
            if not self.more():
                return None
        taken = bytes(self.held[self.at : found])
        self.at = found + len(end)
        return taken

    def skip(self, chars: bytes) -> None:
        while self.has(1) and self.held[self.at] in chars:
            self.at += 1


def parse(data: bytes | memoryview, name: str = "") -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a file; gzipped files may hold many members.

    One pass, in time linear in the file; beside the file it holds one record. A record that
    is cut off or has no valid header raises an error.
    """
    data = memoryview(data)
    feed = _Feed(_inflated(data, name) if bytes(data[:2]) == b"\x1f\x8b" else _pieces(data))
    feed.skip(b"\r\n")
    while feed.has(1):
        begin = feed.passed + feed.at
        head = feed.take_to(_BETWEEN.encode()) if feed.has(5) and feed.held.startswith(b"WARC/", feed.at) else None
        lines = (head or b"").decode("utf-8", "replace").split(_LINE)
        headers = dict((n.strip(), v.strip()) for n, _, v in (line.partition(":") for line in lines[1:]))
        length = headers.get("Content-Length", "")
        block = feed.take(int(length)) if length.isdigit() else None
        if block is None:
            raise ValueError(f"{name}: no whole record at byte {begin}")
        yield headers, block
        feed.skip(b"\r\n")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files, in the columns of ``SOURCE``; other headers stay in ``headers``.

    Files are split among tasks as wholes, as the format asks; one must fit Spark's limit for
    a binary file (2 GB). Each is read in one pass, and its records leave in batches of a few
    megabytes.
    """
    schema = pa.schema(
        [*((n, pa.string()) for n in ("record_id", "type", "target_uri", "date")), ("headers", pa.map_(pa.string(), pa.string())), ("block", pa.binary())]
    )
    named = ("WARC-Record-ID", "WARC-Type", "WARC-Target-URI", "WARC-Date")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        rows, size = [], 0
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                for headers, block in parse(memoryview(content.as_buffer()), name.as_py()):
                    rows.append((*(headers.get(h) for h in named), list(headers.items()), block))
                    size += len(block)
                    if size > 4 << 20 or len(rows) >= 10_000:
                        yield batch_of(rows)
                        rows, size = [], 0
        if rows:
            yield batch_of(rows)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, SOURCE)
