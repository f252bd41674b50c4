"""Registered queries of the text operators against SQL or brute force, on whole tables."""

from __future__ import annotations

import base64
import hashlib
import html
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from math import ceil, floor

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as registry
from conftest import SF, SF_SMALL
from headway.llm import pii
from headway.llm import queries as text_queries

TABLES = ("documents", "pages", "benchmark", "labels", "conversations", "embeddings")


def table(name, folder=SF):
    return pd.read_parquet(f"{folder}/{name}.parquet")


@pytest.mark.parametrize("name", list(text_queries.oracle_sql()))
def test_equals_sql(spark, name):
    db = duckdb.connect()
    for one in TABLES:
        db.sql(f"CREATE VIEW {one} AS SELECT * FROM '{SF}/{one}.parquet'")
    df = text_queries.queries()[name](spark, SF)
    expected = db.sql(text_queries.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    at = [expected.columns.index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == sorted(
        (tuple(r[i] for i in at) for r in expected.fetchall()), key=repr
    )


def test_all_are_registered():
    names = set(registry.queries())
    assert set(text_queries.queries()) < names and "pipeline" in names
    assert {n.split("_")[0] for n in text_queries.queries()} == {f"op{i}" for i in range(1, 14)}


def test_warc_derivatives(spark):
    rows = text_queries.op2_warc_derivatives(spark, SF_SMALL).collect()
    pages = table("pages", SF_SMALL)
    assert Counter(r.type for r in rows) == {"metadata": len(pages), "conversion": len(pages)}
    by_source = defaultdict(dict)
    for r in rows:
        by_source[r.refers_to][r.type] = r
        assert r.content_length == len(r.block.encode())
    for pair in by_source.values():
        meta, text = pair["metadata"], pair["conversion"]
        assert f"conversion-record: {text.record_id}\r\n" in meta.block and meta.linked_record == text.record_id
        assert text.linked_record == meta.record_id and text.target_uri == meta.target_uri
    sizes = {u: len(h.encode()) for u, h in zip(pages.url, pages.html)}
    for r in rows:
        if r.type == "metadata":
            assert f"source-payload-length: {sizes[r.target_uri]}\r\n" in r.block


def test_warc_digests_headers_and_text(spark):
    """Every record against digests, headers and text taken from the page itself."""
    sha1 = lambda data: "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
    found = defaultdict(dict)
    for r in text_queries.op2_warc_derivatives(spark, SF_SMALL).collect():
        assert r.block_digest == sha1(r.block.encode())
        found[r.target_uri][r.type] = r
    pages = table("pages", SF_SMALL)
    assert len(found) == len(pages)
    for url, page in zip(pages.url, pages.html):
        body = page.encode()
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
        meta, text = found[url]["metadata"], found[url]["conversion"]
        fields = dict(line.split(": ", 1) for line in meta.block.split("\r\n") if line)
        assert fields["source-block-digest"] == sha1(head + body) and fields["source-payload-digest"] == sha1(body)
        assert fields["source-payload-length"] == fields["http-Content-Length"] == str(len(body))
        assert fields["http-status"] == "HTTP/1.1 200 OK" and fields["http-Content-Type"] == "text/html; charset=utf-8"
        assert fields["source-Content-Type"] == "application/http; msgtype=response"
        assert fields["conversion-block-digest"] == text.block_digest == text.payload_digest
        assert meta.refers_to == text.refers_to and meta.date == text.date == "2024-01-01T00:00:00Z"
        # All text of the page, scripts, styles and the title apart, whatever the line ends.
        plain = re.sub(r"(?is)<(script|style|title)\b.*?(</\1[^>]*>|$)|<!--.*?-->", " ", page)
        plain = html.unescape(re.sub(r"<[^>]*(>|$)", "", plain))
        assert "".join(text.block.split()) == "".join(plain.split())


def brute_mix(counts: dict[str, int], weights: dict[str, float], size: int):
    """Source of every slot, one slot after another over all blocks, from exact shares."""
    blocks = {s: -(-n // size) for s, n in counts.items()}
    order = []
    while any(blocks.values()):
        total = sum(Fraction(weights[s]) for s, n in blocks.items() if n)
        share = {s: Fraction(weights[s]) / total for s, n in blocks.items() if n}
        given = dict.fromkeys(share, 0)
        now = 0
        while True:
            ready = [s for s in share if floor(given[s] / share[s]) <= now]
            s = min(ready, key=lambda s: (ceil((given[s] + 1) / share[s]), s))
            order.append(s)
            given[s] += 1
            blocks[s] -= 1
            now += 1
            for t in share:  # Pfair: less than one block from the share
                assert abs(given[t] - now * share[t]) < 1
            if blocks[s] == 0:
                break
    return order


def test_mixing(spark):
    rows = text_queries.op3_mixing(spark, SF).toPandas()
    docs = table("documents")
    assert sorted(rows.doc_id) == sorted(docs.doc_id) and rows.position.is_unique
    counts = docs.groupby("source").size().to_dict()
    expected = brute_mix(counts, {s: n**0.5 for s, n in counts.items()}, 16)
    assert rows.groupby("slot").source.agg(["min", "max", "size"]).reset_index()["min"].tolist() == expected
    assert (rows.groupby("slot").source.nunique() == 1).all() and rows.groupby("slot").size().max() <= 16
    for source, own in rows.groupby("source"):
        assert sorted(own["index"]) == list(range(counts[source]))


def test_tokens_equal_the_library(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    docs = table("documents")
    rows = text_queries.op4_bpe(spark, SF).toPandas().set_index("doc_id")
    for doc_id, found in zip(docs.doc_id, library.encode_batch(docs.text.to_list(), add_special_tokens=False)):
        ids = found.ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        decoded = library.decode(ids, skip_special_tokens=False)
        expected = [len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()]
        assert rows.loc[doc_id].to_list() == expected


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def is_valid(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
        "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 10 <= len(digits) <= 15,
    }[kind]()


def base_spans(text: str | None) -> list[str]:
    found = [
        (m.start(), i, m.end(), kind)
        for i, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if is_valid(kind, m.group())
    ]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


HARD = [
    None, "", "a@b", "x a@b.c_d@e.f. 1.2.3.4.5 1.2.3.999 999.1.1.1 0001.2.3.4", "4111 1111 1111 1111, 4111-1111-1111-1112",
    "+1 (017) 555-7713) +49-30-1234567- +12", "é👍 +44 20 7946 0958 äö a.b+c@x-y.org", "1" * 3000, "9 " * 3000,
    "a" * 20000 + "@", "." * 5000, "a.a" * 4000 + "@b" + ".c" * 4000, "+" * 3000 + "1234567890123",
    "79927398713 4111111111111111@x.de 10.0.0.1:80 " * 50, "call (555) 123-4567 or 555-123-4567", "me [at] site [dot] com",
    "99999999999.1.1.1 1.00000000000000255.1.1", "mail: x@y.com\n+1\n234 567 8901",
]


def test_personal_data(spark):
    rows = text_queries.op6_pii(spark, SF).toPandas().set_index("doc_id")
    for doc_id, text in zip(*(table("documents")[c] for c in ("doc_id", "text"))):
        base = base_spans(text)
        row = rows.loc[doc_id]
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in PATTERNS] == [sum(b.startswith(k) for b in base) for k in PATTERNS]
        assert set(base) <= set(row.spans.split(",")) | {""}
        assert row.n_spans == len([x for x in row.spans.split(",") if x])
        # The tables' secrets, and nothing else, are added as such.
        secrets = [f"secret:{m.start(1)}:{m.end(1)}" for m in re.finditer(r'token = "([0-9a-f]{40})"', text or "")]
        assert [x for x in row.spans.split(",") if x.startswith("secret")] == secrets


def test_personal_data_in_hard_texts(spark):
    docs = spark.createDataFrame(list(enumerate(HARD)), "doc_id bigint, text string")
    rows = pii.find(docs).select("id", pii.as_text("base").alias("base"), pii.as_text("spans").alias("spans")).collect()
    for r in rows:
        assert r.base == ",".join(base_spans(HARD[r.id])), HARD[r.id][:60]
        assert set(filter(None, r.base.split(","))) <= set(r.spans.split(","))


def test_language_on_held_out_documents(spark):
    rows = text_queries.op8_language_id(spark, SF).toPandas().set_index("doc_id")
    docs = table("documents").set_index("doc_id")
    held_out = pd.Series({i: zlib.crc32(str(i).encode()) % 4 == 2 for i in docs.index})
    assert (rows.held_out.loc[docs.index] == held_out).all()
    assert rows.score.between(0, 1).all()
    right = rows.lang_pred.loc[docs.index] == docs.lang
    assert right[held_out].mean() > 0.98


def article(page: str) -> str:
    inner = re.search(r"<article>(.*?)(</article>|$)", page, re.DOTALL)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]*(>|$)", " ", inner)).split())


def test_main_text(spark):
    rows = text_queries.op10_html_text(spark, SF).toPandas().set_index("page_id")
    for page_id, page in zip(*(table("pages")[c] for c in ("page_id", "html"))):
        assert rows.loc[page_id].text == article(page)
        assert rows.loc[page_id].n_chars == len(article(page))


def test_whitening(spark):
    rows = text_queries.op12_whitening(spark, SF).toPandas()
    vectors = table("embeddings").set_index("vec_id").embedding
    x = np.floor(np.stack(vectors).astype(float) * 64).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    covariance = centred.T @ centred / n
    values, components = np.linalg.eigh(covariance)
    values, components = values[::-1][:32], components[:, ::-1][:, :32]
    expected = centred @ components / np.sqrt(values)
    found = rows.pivot(index="vec_id", columns="component", values="whitened").loc[vectors.index]
    assert list(found.columns) == list(range(1, 33)) and (rows.n == n).all()
    signs = np.sign((expected * found).sum(axis=0).to_numpy())
    assert np.abs(found.to_numpy() - expected * signs).max() < 1e-8
    apart = rows.drop_duplicates("vec_id").set_index("vec_id").deviation
    assert (apart.loc[vectors.index] == ((n * x - sums) ** 2).sum(axis=1)).all()
    explained = rows.drop_duplicates("component").set_index("component").explained
    assert np.allclose(explained.loc[range(1, 33)], values / np.trace(covariance), rtol=1e-10)
    whitened = found.to_numpy()
    error = np.abs(whitened.T @ whitened / n - np.eye(32)).max()
    assert rows.identity_error.nunique() == 1 and rows.identity_error[0] < 1e-8 and error < 1e-8


def test_deep_paths_equal_sql(spark, tmp_path):
    """Rows that part below the sixth segment, with many children there, on three hosts."""
    hosts, tops = ("a.example.org", "b.net", "shop.com"), ("es", "en", "de", "fr")
    rows = []
    for i in range(400):
        deep = "/".join(("x", "y", "z", "q", "r", ("left", "right")[i % 2], f"name{'abcdefghijklmnopqrstuvwxyz'[i % 26]}", "end")[: 5 + i % 4])
        rows.append((i, f"https://{hosts[i % 3]}/{tops[i % 4]}/{deep}/{chr(97 + i % 23)}{chr(97 + i % 19)}"))
    rows += [(1000, None), (1001, "no scheme"), (1002, "http://b.net"), (1002, "http://b.net")]
    spark.createDataFrame(rows, "page_id bigint, url string").write.parquet(f"{tmp_path}/pages.parquet")
    found = text_queries.op5_url_filter(spark, str(tmp_path))
    columns = ["page_id", "host", "path", "rule", "template", "share", "verdict"]
    ours = sorted(map(str, (tuple(r[c] for c in columns) for r in found.collect())))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    theirs = db.sql(f"SELECT {', '.join(columns)} FROM ({text_queries.oracle_sql()['op5_url_filter']})").fetchall()
    assert ours == sorted(map(str, theirs))
    assert any(r.template.count("/") > 7 for r in found.collect())
