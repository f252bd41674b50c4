"""The corpus pipeline against plain Python, stage by stage."""

from __future__ import annotations

import itertools
import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF, SF_SMALL
from headway.llm import mixing
from headway.llm import queries as text_queries
from headway.sources.scratch import new_folder, written

WORD = re.compile("[^\x20\x09-\x0d]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def shingles(text, n):
    words = WORD.findall(lowered(text or ""))
    size = min(n, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if size else set()


def one_of_each(docs: pd.DataFrame, n: int) -> set[int]:
    sets = {i: shingles(t, n) for i, t in zip(docs.doc_id, docs.text)}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((root(a), root(b)))
            label[y] = x
    return {i for i in sets if root(i) == i}


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returns, on whole tables."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), new_folder(spark, name))
        found.append((docs, docs.toPandas()))
    return found


def test_quality(stages):
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    judged = db.sql(text_queries.oracle_sql()["op9_quality_rules"]).df()
    assert sorted(stages[0][1].doc_id) == sorted(judged[judged.kept].doc_id)
    labels = pd.read_parquet(f"{SF}/labels.parquet").merge(judged, on="doc_id")
    good = labels[(labels.quality == 1) & ~labels.base_failed]
    assert good.kept.all()
    bad = labels[(labels.quality == 0) & (labels.n_words >= 100)]
    assert not bad.kept.any()


def test_exact_copies(stages):
    before, after = stages[0][1], stages[1][1]
    flat = before.text.str.replace("[\x20\x09-\x0d]+", " ", regex=True)
    assert sorted(after.doc_id) == sorted(before.groupby(flat).doc_id.min())


def test_near_copies(stages):
    before, after = stages[1][1], stages[2][1]
    assert set(after.doc_id) == one_of_each(before, 5)


def test_mix_keeps_all_and_orders_files(stages):
    before, after = stages[2], stages[3]
    assert sorted(after[1].doc_id) == sorted(before[1].doc_id)
    position = {r.id: r.position for r in mixing.mix(before[0]).collect()}
    inside = after[0].selectExpr("doc_id", "input_file_name() AS file").toPandas()
    places = [inside[inside.file == f].doc_id.map(position) for f in sorted(inside.file.unique())]
    assert all(p.is_monotonic_increasing for p in places)
    assert all(a.iloc[-1] < b.iloc[0] for a, b in zip(places, places[1:]))


def test_tokens(stages):
    last = stages[4][1]
    library = Tokenizer.from_file(corpus_pipeline.VOCABULARY)
    expected = [e.ids for e in library.encode_batch(last.text.to_list(), add_special_tokens=False)]
    assert [list(ids) for ids in last.token_ids] == expected


def test_stages_return_documents(stages):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(list(df.columns) == columns for df, _ in stages[:-1])
    assert list(stages[-1][0].columns) == [*columns, "token_ids"]


def test_run(spark):
    """run() on the small folder holds just what plain Python keeps."""
    docs = pd.read_parquet(f"{SF_SMALL}/documents.parquet")
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    judged = db.sql(text_queries.oracle_sql()["op9_quality_rules"]).df()
    docs = docs[docs.doc_id.isin(judged[judged.kept].doc_id)]
    flat = docs.text.str.replace("[\x20\x09-\x0d]+", " ", regex=True)
    docs = docs[docs.doc_id.isin(docs.groupby(flat).doc_id.min())]
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(one_of_each(docs, 5))


def test_run_returns_rows_in_mixed_order(spark):
    """Also where the stages write several files."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    finally:
        spark.conf.unset(setting)
    kept = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where(F.col("doc_id").isin([r.doc_id for r in rows]))
    expected = [r.id for r in mixing.mix(kept).orderBy("position").collect()]
    assert [r.doc_id for r in rows] == expected


def test_run_on_odd_rows(spark, tmp_path):
    """Null identifiers, sources and languages, repeated rows and names that stages use themselves."""
    prose = lambda k: " ".join(f"{chr(97 + i % 26)}{chr(97 + i * k % 23)}{chr(97 + i // 5)}" for i in range(100))
    rows = [(1, prose(1), "en", "a"), (1, prose(1), "en", "a"), (None, prose(5), None, None), (None, prose(7), "en", "a"), (2, None, "en", "a"), (3, "", None, None)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars int, row string, id int, kept boolean, position int"
    spark.createDataFrame([(*r, 0, "r", 7, True, 9) for r in rows], schema).write.parquet(f"{tmp_path}/odd/documents.parquet")
    found = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    assert sorted((r.doc_id or 0, r.text) for r in found) == sorted([(1, prose(1)), (0, prose(5)), (0, prose(7))])
    assert all((r.row, r.id, r.kept, r.position) == ("r", 7, True, 9) and len(r.token_ids) > 0 for r in found)
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
