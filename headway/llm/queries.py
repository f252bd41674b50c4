"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import (
    bpe,
    chat,
    exact_dedup,
    hard_negatives,
    html_diff,
    language,
    mixing,
    near_dedup,
    pii,
    quality,
    sql,
    url_filter,
    warc,
    whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = near_dedup.Options(shingle=2, percent=80)
    found = near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), options=options)
    return found.select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept"
    )


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.responses(_table(spark, sf_dir, "pages"), "2024-01-01T00:00:00Z"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.withColumnRenamed("id", "doc_id")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.round_trip(_table(spark, sf_dir, "documents"), path).withColumnRenamed("id", "doc_id")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.verdicts(_table(spark, sf_dir, "pages"))
    return judged.withColumnRenamed("id", "page_id").withColumn("share", F.round("share", 6))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents"))
    of = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("bigint")
    return found.select(
        F.col("id").alias("doc_id"),
        *(of(i).alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)),
        F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"),
        pii.as_text(F.col("spans")).alias("spans"),
        F.size("spans").cast("bigint").alias("n_spans"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    model = language.fit(docs.where(fold != 2))
    found = language.predict(docs, model).withColumnRenamed("id", "doc_id")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_diff.extract(_table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.group_copies(_table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("key").alias("doc_id"),
        F.col("keep_key").alias("keep_id"),
        F.col("copies").alias("group_size"),
        "kept",
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"))
    return judged.select(
        "row.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.round("class_distance", 6).alias("class_distance"),
        F.round("word_distance", 6).alias("word_distance"),
        "kept",
    )


def op11_chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings."""
    turn = F.col("id")
    planted = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        turn.alias("turn"),
        F.when(turn == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    told = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat.digests(chat.examples(told)).withColumnRenamed("conv", "conv_id")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.by_component(*whitening.whiten(_table(spark, sf_dir, "embeddings"), components=32))
    return rows.withColumnRenamed("id", "vec_id").withColumn("deviation", F.col("deviation").cast("bigint"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    changed = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"), vec_id % 50 == 0, changed)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_near_dedup": op1_near_dedup,
        "op2_warc_derivatives": op2_warc_derivatives,
        "op3_mixing": op3_mixing,
        "op4_bpe": op4_bpe,
        "op5_url_filter": op5_url_filter,
        "op6_pii": op6_pii,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_language_id": op8_language_id,
        "op9_quality_rules": op9_quality_rules,
        "op10_html_text": op10_html_text,
        "op11_chat_examples": op11_chat_examples,
        "op12_whitening": op12_whitening,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    return sql.statements()
