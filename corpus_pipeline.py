"""From raw documents to a mixed, encoded training corpus, in five stages.

Each stage takes what the one before it kept, written as Parquet and read again. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from headway.llm import bpe, exact_dedup, mixing, near_dedup, quality
from headway.sources.scratch import new_folder, written

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie near the reference of their language."""
    return quality.keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles of similarity 0.8 or more."""
    return near_dedup.keep_one_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix."""
    return mixing.in_mixed_order(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the token ids of their whole texts, in the order of the mix: files are
    not read in the order in which they were written, so the places are computed again."""
    return bpe.with_tokens(mixing.in_mixed_order(docs), VOCABULARY)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("mixing", mixed_sources),
    ("bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, new_folder(spark, f"stage-{name}"))
    return docs


# Scheduling and merging are not expressible in SQL; tests hold run() against plain Python.
ORACLE_SQL = None
