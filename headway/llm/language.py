"""Language by nearest centroid over TF-IDF vectors of character n-grams.

A text's vector counts its byte pairs and triples (A-Z as lower case, other ASCII characters
as one space), hashed to a fixed number of places, damped by a logarithm, weighted by inverse
document frequency and scaled to length one. Each language has several centroids, found by
spherical k-means over its training vectors; a text gets the language of the centroid with
the largest cosine. A text farther from it than nearly all training texts of that language
are from theirs is marked as rejected.

The model is fitted on a bounded sample: per language the ``per_language`` rows whose
identifiers have the smallest hashes, ``sample`` rows together at most (but ten of each
language). The limit holds per language and on rows, so neither a large language nor a
repeated identifier takes another language's place. Prediction reads every text whole;
memory follows a slice of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.shingles import text_bytes

UNDETERMINED = "und"
_PLACES = 4096
_PIECE = 1 << 20
_ROWS = 128
_SHOWN = np.full(256, 0x20, dtype=np.uint8)
_SHOWN[0x80:] = np.arange(0x80, 0x100)
_SHOWN[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_SHOWN[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Options:
    per_language: int = 400
    sample: int = 4000
    clusters: int = 4
    rounds: int = 12
    reject_beyond: float = 0.999


@dataclass(frozen=True)
class Model:
    """``centroids`` has a row per cluster, ``owner`` the place of its language in ``languages``,
    ``limits`` the largest accepted cosine distance per language."""

    languages: tuple[str, ...]
    weights: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    limits: np.ndarray


def counts_of(data: np.ndarray) -> np.ndarray:
    """Hashed counts of byte pairs and triples of one text, piece by piece."""
    total = np.zeros(_PLACES, np.int64)
    for start in range(0, len(data), _PIECE):
        shown = _SHOWN[data[max(0, start - 2) : start + _PIECE]]
        keep = np.ones(len(shown), bool)
        keep[1:] = (shown[1:] != 0x20) | (shown[:-1] != 0x20)
        b = shown[keep].astype(np.uint32)
        pairs = b[:-1] << np.uint32(8) | b[1:]
        triples = pairs[:-1] << np.uint32(8) | b[2:]
        for grams, salt in ((pairs, 0x9E3779B1), (triples, 0x85EBCA77)):
            places = (grams * np.uint32(salt)) >> np.uint32(20)
            total += np.bincount(places, minlength=_PLACES)
    return total


def vectors(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    found = np.log1p(counts.astype(np.float32)) * weights
    norms = np.linalg.norm(found, axis=1, keepdims=True)
    return found / np.maximum(norms, 1e-12)


def has_letter(data: bytes) -> bool:
    return bool(_ASCII_LETTER.search(data)) or bool(_LETTER.search(data.decode("utf-8", "replace")))


def _clusters(rows: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Spherical k-means; starts from the mean's nearest row and then the farthest ones."""
    chosen = [int(np.argmax(rows @ rows.mean(axis=0)))]
    while len(chosen) < min(k, len(rows)):
        nearest = (rows @ rows[chosen].T).max(axis=1)
        if nearest.min() > 1 - 1e-6:
            break
        chosen.append(int(np.argmin(nearest)))
    centroids = rows[chosen]
    for _ in range(rounds):
        member = np.argmax(rows @ centroids.T, axis=1)
        sums = np.stack([rows[member == c].sum(axis=0) for c in range(len(centroids))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centroids)
    return centroids.astype(np.float32)


def fit_counts(languages: list[str], counts: np.ndarray, options: Options = Options()) -> Model:
    names = sorted(set(languages))
    if not names:
        empty = np.empty((0, _PLACES), np.float32)
        return Model((), np.ones(_PLACES, np.float32), empty, np.empty(0, int), np.empty(0))
    present = (counts > 0).sum(axis=0)
    weights = (np.log((1 + len(counts)) / (1 + present)) + 1).astype(np.float32)
    rows = vectors(counts, weights)
    owners = np.array([names.index(x) for x in languages])
    centroids, owner, limits = [], [], []
    for i in range(len(names)):
        own = rows[owners == i]
        found = _clusters(own, options.clusters, options.rounds)
        centroids.append(found)
        owner += [i] * len(found)
        limits.append(float(np.quantile(1 - (own @ found.T).max(axis=1), options.reject_beyond)))
    return Model(tuple(names), weights, np.concatenate(centroids), np.array(owner), np.array(limits))


def _gram_counts(texts: DataFrame) -> DataFrame:
    """(lang, rank, counts) of rows (lang, text, rank) whose text has a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            langs, ranks, found = [], [], []
            for i, (lang, rank) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                own = data[offsets[i] : offsets[i + 1]]
                if has_letter(own.tobytes()):
                    langs.append(lang)
                    ranks.append(rank)
                    found.append(counts_of(own).astype(np.float32).tobytes())
            columns = [pa.array(langs, pa.string()), pa.array(ranks, pa.int32()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "rank", "counts"])

    return texts.mapInArrow(run, "lang string, rank int, counts binary")


def fit(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", options: Options = Options()) -> Model:
    """Model of the languages named in ``docs``; rows without one teach nothing.

    Rows are chosen by identifier without their texts; the choice, at most ``each`` rows of
    each language, is broadcast, so texts that are not chosen are never shuffled. Rows that
    repeat an identifier, null included, are told apart by their text's hash, and equal rows
    are alike.
    """
    lang = F.col(lang_col).cast("string").alias("lang")
    named = docs.where(F.col(lang_col).isNotNull())
    n_languages = named.select(lang).distinct().count()
    if n_languages == 0:
        return fit_counts([], np.empty((0, _PLACES)), options)
    each = max(10, min(options.per_language, options.sample // n_languages))
    # Ranks stop at ``each`` in every task.
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    ids = named.select(F.col(id_col).alias("id"), lang).withColumn("rank", F.row_number().over(order))
    ids = ids.where(F.col("rank") <= each).select(F.col("id").alias("chosen"), F.col("lang").alias("of")).distinct()
    texts = named.select(F.col(id_col).alias("id"), lang, F.col(text_col).cast("string").alias("text"))
    texts = texts.join(F.broadcast(ids), (F.col("lang") == F.col("of")) & F.col("id").eqNullSafe(F.col("chosen")), "left_semi")
    place = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", F.xxhash64("text"))
    texts = texts.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= each)
    rows = sorted(_gram_counts(texts.select("lang", "text", "rank")).collect(), key=lambda r: (r["lang"], r["rank"]))
    counts = np.stack([np.frombuffer(r["counts"], np.float32) for r in rows]) if rows else np.empty((0, _PLACES))
    return fit_counts([r["lang"] for r in rows], counts, options)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected) per row, from its text alone.

    ``score`` is the cosine to the nearest centroid, 0 to 1. A null text and one without any
    letter are 'und' with score 0, and so is every text where the model knows no language.
    Ties go to the language that sorts first. Repeated rows give repeated results; an empty
    table gives none; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            n = len(batch)
            names, scores, rejected = [UNDETERMINED] * n, np.zeros(n), np.ones(n, bool)
            for start in range(0, n, _ROWS):
                own = [data[offsets[i] : offsets[i + 1]] for i in range(start, min(n, start + _ROWS))]
                lettered = [i for i, d in enumerate(own) if has_letter(d.tobytes())]
                if not lettered or not model.languages:
                    continue
                cosines = vectors(np.stack([counts_of(own[i]) for i in lettered]), model.weights) @ model.centroids.T
                best = np.argmax(cosines, axis=1)
                for i, c, row in zip(lettered, best, cosines):
                    language = model.owner[c]
                    names[start + i] = model.languages[language]
                    scores[start + i] = min(1.0, max(0.0, float(row[c])))
                    rejected[start + i] = 1 - row[c] > model.limits[language]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores), pa.array(rejected)],
                names=["id", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double, rejected boolean")
