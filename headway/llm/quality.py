"""Document quality by divergence from language references.

A reference holds two distributions of a language, counted over all its documents: of
characters over classes, and of words over its most common short words (common words are
short in every language written with spaces, which keeps the counts small). A document is
rejected when its own distributions lie too far from the reference of its language by
Jensen-Shannon distance, provided it is long enough for the distance to mean something.
Five plain counts and two base rules come first.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.text import at_end, first_step, next_step, packed, whole, words
from headway.sources.scratch import new_folder, written

_POOLED = ""

# The limits of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Character classes. Lower-case letters and spaces make one, for their runs are long and one
# pass takes them out of a text; the others are taken out of what is left, one by one.
_CLASSES = (
    ("body", r"[\p{Ll} ]+"),
    ("upper", r"[\p{Lu}\p{Lt}]+"),
    ("symbol", r"[#*$%&|<>]+"),
    ("digit", r"\p{Nd}+"),
    ("stop", r"[.,]+"),
    ("break", r"[\x09-\x0D]+"),
    ("mark", r"\p{P}+"),
)
CLASS_NAMES = (*(name for name, _ in _CLASSES), "other")


@dataclass(frozen=True)
class Limits:
    """Method parameters.

    ``top_words`` common words of at most ``word_chars`` characters make a word histogram.
    Languages with fewer than ``reference_words`` words, and documents without a language,
    have no reference that fits; their distances are to the pooled one and reject nothing.
    Distances count for documents of at least
    ``guard_words`` words, and both limits rise by ``allowance`` over the number of words, for
    a short text strays further by chance.

    A text without any common word has a distance of its own, well below the limit on words.
    Where chance, with ``word_spread`` on top, takes good texts less far than that, the
    limit lies below it by ``word_margin`` of the room between both. With 32 common words
    that hold a quarter of a language, this is so from 82 words on.
    """

    top_words: int = 32
    word_chars: int = 6
    reference_words: int = 2000
    guard_words: int = 50
    max_class_distance: float = 0.28
    max_word_distance: float = 0.42
    allowance: float = 2.0
    word_spread: float = 0.1
    word_margin: float = 0.25


def _with_classes(rows: DataFrame) -> DataFrame:
    """Adds ``classes``, the number of characters per class, to rows with ``text``."""
    kept = rows.columns
    done: list[str] = []
    step = rows.select(*kept, F.col("text").alias("left"), F.length("text").alias("len"))
    for name, pattern in _CLASSES:
        step = step.select(*kept, *done, "len", F.regexp_replace("left", pattern, "").alias("left"))
        step = step.select(
            *kept, *done, (F.col("len") - F.length("left")).alias(name), F.length("left").alias("len"), "left"
        )
        done.append(name)
    counts = [*(F.col(name) for name in done), F.col("len")]
    return step.select(*kept, F.array(*(c.cast("bigint") for c in counts)).alias("classes"))


# Words in repeated three-word windows. A window's hash gives up its low bits for the number
# of its first word, so that one sort of plain numbers brings equal windows together; the
# words themselves decide about neighbours. Then every repeated window covers the words up
# to the next one.
_WINDOWS = """
CASE WHEN size(words) < 4 THEN CAST(array() AS array<bigint>) ELSE
  sort_array(transform(sequence(0, size(words) - 3), i ->
    (xxhash64(words[i], words[i + 1], words[i + 2]) & high) | i))
END"""
_NEIGHBOURS = """
CASE WHEN size(windows) < 2 THEN CAST(array() AS array<int>) ELSE
  filter(sequence(0, size(windows) - 2), j -> (windows[j] & high) = (windows[j + 1] & high))
END"""
_REPEATED = """
CASE WHEN size(near) = 0 THEN CAST(array() AS array<int>) ELSE
  sort_array(array_distinct(flatten(transform(
    filter(
      transform(near, j -> named_struct('a', CAST(windows[j] & ~high AS int),
                                        'b', CAST(windows[j + 1] & ~high AS int))),
      p -> words[p.a] = words[p.b] AND words[p.a + 1] = words[p.b + 1] AND words[p.a + 2] = words[p.b + 2]),
    p -> array(p.a, p.b)))))
END"""
_COVERED = """
CASE WHEN size(starts) = 0 THEN 0L
     WHEN size(starts) = 1 THEN 3L
     ELSE 3L + aggregate(sequence(0, size(starts) - 2), 0L, (sum, j) -> sum + least(3, starts[j + 1] - starts[j]))
END"""
_DUP_LINES = r"""
size(filter(split(text, '\n'), l -> l RLIKE '[^\\x20\\x09-\\x0D]'))
- size(array_distinct(filter(split(text, '\n'), l -> l RLIKE '[^\\x20\\x09-\\x0D]')))"""


def _with_repeats(rows: DataFrame) -> DataFrame:
    kept = [c for c in rows.columns if c not in ("text", "step")]
    high = F.expr("shiftleft(-1L, length(bin(size(words))))").alias("high")
    step = rows.select(*kept, F.expr(_DUP_LINES).cast("bigint").alias("n_dup_lines"), high, next_step())
    kept.append("n_dup_lines")
    step = step.select(*kept, "high", F.expr(_WINDOWS).alias("windows"), next_step())
    step = step.select(*kept, "high", "windows", F.expr(_NEIGHBOURS).alias("near"), next_step())
    step = step.select(*kept, F.expr(_REPEATED).alias("starts"), next_step())
    return step.select(*kept, F.expr(_COVERED).alias("n_repeat_words"), next_step())


def references(docs: DataFrame, lang_col: str, text_col: str, limits: Limits) -> DataFrame:
    """One row per language ("=" and its name) and one with key "" for all documents together:
    ref_key, ref_classes (shares), ref_words, ref_shares."""
    lang = F.coalesce(F.concat(F.lit("="), F.col(lang_col).cast("string")), F.lit(_POOLED))
    rows = docs.select(lang.alias("ref_key"), whole(text_col).alias("text"))
    sums = [F.sum(F.col("classes")[i]).alias(name) for i, name in enumerate(CLASS_NAMES)]
    totals = _with_classes(rows).groupBy("ref_key").agg(*sums)
    # Long words are counted together, as the null word.
    word = F.explode(words(F.col("text"))).alias("word")
    short = F.when(F.length("word") <= limits.word_chars, F.col("word")).alias("word")
    counts = rows.select("ref_key", word).groupBy("ref_key", short).agg(F.count("*").alias("n"))
    spark = docs.sparkSession
    totals = written(totals, new_folder(spark, "class-totals"))
    counts = written(counts, new_folder(spark, "word-counts"))
    pooled = F.lit(_POOLED).alias("ref_key")
    own = F.col("ref_key") != _POOLED
    return _references_of(totals.where(own), counts.where(own), limits.reference_words, limits).unionByName(
        _references_of(
            totals.groupBy(pooled).agg(*(F.sum(c).alias(c) for c in CLASS_NAMES)),
            counts.groupBy(pooled, "word").agg(F.sum("n").alias("n")),
            0,
            limits,
        )
    )


def _references_of(totals: DataFrame, counts: DataFrame, least_words: int, limits: Limits) -> DataFrame:
    """References of the keys with enough words."""
    best = Window.partitionBy("ref_key").orderBy(F.desc("n"), "word")
    top = counts.where(F.col("word").isNotNull()).withColumn("rank", F.row_number().over(best))
    top = top.where(F.col("rank") <= limits.top_words).groupBy("ref_key").agg(
        F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("common")
    )
    sizes = counts.groupBy("ref_key").agg(F.sum("n").cast("double").alias("n_words"))
    chars = sum((F.col(name) for name in CLASS_NAMES), F.lit(0))
    return (
        totals.join(sizes, "ref_key", "left")
        .join(top, "ref_key", "left")
        .where(F.coalesce("n_words", F.lit(0)) >= least_words)
        .select(
            "ref_key",
            F.array(*(F.when(chars > 0, F.col(n) / chars).otherwise(0.0) for n in CLASS_NAMES)).alias("ref_classes"),
            F.coalesce(F.col("common.word"), F.array().cast("array<string>")).alias("ref_words"),
            F.coalesce(
                F.transform("common", lambda c: c["n"] / F.col("n_words")), F.array().cast("array<double>")
            ).alias("ref_shares"),
        )
    )


def _divergence(p: str, q: str) -> str:
    """One bin's part of the Jensen-Shannon divergence, in bits."""
    return (
        f"(CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0D END"
        f" + CASE WHEN {q} > 0 THEN {q} * log2(2 * {q} / ({p} + {q})) ELSE 0D END) / 2"
    )


_CLASS_DISTANCE = f"""
sqrt(greatest(0D, aggregate(
  zip_with(transform(classes, c -> c / n_chars), ref_classes, (p, q) -> {_divergence('p', 'q')}),
  0D, (sum, x) -> sum + x)))"""
# Positions in the list of common words, in order; equal ones are neighbours.
_HITS = """
sort_array(filter(
  transform(words, w -> CASE WHEN length(w) <= {word_chars} THEN array_position(ref_words, w) ELSE 0L END),
  x -> x > 0))"""
_ENDS = """
CASE WHEN size(hits) = 0 THEN CAST(array() AS array<int>) ELSE
  filter(sequence(1, size(hits)), i -> i = size(hits) OR hits[i - 1] <> hits[least(i, size(hits) - 1)])
END"""
_HISTOGRAM = """
CASE WHEN size(ends) = 0 THEN CAST(array() AS array<struct<p: double, q: double>>) ELSE
  transform(sequence(0, size(ends) - 1), i -> named_struct(
    'p', (ends[i] - CASE WHEN i = 0 THEN 0 ELSE ends[greatest(i - 1, 0)] END) / CAST(n_words AS double),
    'q', ref_shares[CAST(hits[ends[i] - 1] - 1 AS int)]))
END"""
# Common words the document lacks add half their share; all other words are one bin.
_WORD_DISTANCE = f"""
sqrt(greatest(0D,
  aggregate(histogram, 0D, (sum, h) -> sum + {_divergence('h.p', 'h.q')})
  + (ref_all - aggregate(histogram, 0D, (sum, h) -> sum + h.q)) / 2
  + {_divergence('(1 - size(hits) / CAST(n_words AS double))', '(1 - ref_all)')}))"""
# Of a text that has none of the common words.
_NONE_DISTANCE = f"sqrt(greatest(0D, ref_all / 2 + {_divergence('1D', '(1 - ref_all)')}))"


def _word_limit(limits: Limits) -> Column:
    """Chance: the expected divergence of a sample is its bins over 8 n, in nats."""
    n = F.greatest("n_words", F.lit(1))
    chance = F.sqrt(F.lit(limits.top_words / (8 * log(2))) / n) + limits.word_spread
    none = F.expr(_NONE_DISTANCE)
    below = F.when(chance < none, none - limits.word_margin * (none - chance))
    return F.least(limits.max_word_distance + limits.allowance / n, below)


def judge(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    limits: Limits = Limits(),
) -> DataFrame:
    """Every row (``row``) with its counts, distances and verdict.

    Columns: row, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    class_distance, word_distance, kept. A null text has no words and fails the base rules;
    distances are null below the length guard, and a word distance also where the reference
    has no common words. Documents in a language without its own reference, or in none, are
    compared with all documents together, which rejects none of them. Repeated rows are judged alike; an empty table
    gives no rows; columns other than language and text are only carried in ``row``.
    """
    reference = written(references(docs, lang_col, text_col, limits), new_folder(docs.sparkSession, "references"))
    own = reference.where(F.col("ref_key") != _POOLED)
    # One row of fixed size; languages without a reference get it as constants.
    pooled = reference.where(F.col("ref_key") == _POOLED).first()
    kinds = {"ref_classes": "array<double>", "ref_words": "array<string>", "ref_shares": "array<double>"}
    constant = {c: F.array(*map(F.lit, pooled[c] if pooled else [])).cast(kind) for c, kind in kinds.items()}
    rows = packed(docs, lang=F.concat(F.lit("="), F.col(lang_col).cast("string")), text=whole(text_col))
    chars = F.aggregate("words", F.lit(0).cast("bigint"), lambda total, w: total + F.length(w))
    rows = _with_classes(rows).select("*", words(F.col("text")).alias("words"), first_step())
    rows = rows.select("row", "lang", "text", "classes", "words", chars.alias("word_chars"), next_step())
    rows = _with_repeats(rows)
    rows = rows.join(own, rows["lang"] == own["ref_key"], "left")
    rows = rows.select(
        "row", "words", "classes", "word_chars", "n_dup_lines", "n_repeat_words",
        F.size("words").cast("bigint").alias("n_words"),
        *(F.coalesce(F.col(c), other).alias(c) for c, other in constant.items()),
        F.col("ref_key").isNotNull().alias("fitting"),
        next_step(),
    )
    counts = ["row", "n_words", "word_chars", "n_dup_lines", "n_repeat_words", "fitting"]
    rows = rows.select(
        *counts, "classes", "ref_classes", "ref_shares",
        F.expr(_HITS.format(word_chars=limits.word_chars)).alias("hits"),
        F.expr("aggregate(classes, 0L, (sum, c) -> sum + c)").alias("n_chars"),
        F.expr("aggregate(ref_shares, 0D, (sum, s) -> sum + s)").alias("ref_all"),
        next_step(),
    )
    carried = [c for c in rows.columns if c != "step"]
    rows = rows.select(*carried, F.expr(_ENDS).alias("ends"), next_step())
    rows = rows.select(*carried, F.expr(_HISTOGRAM).alias("histogram"), next_step())
    long_enough = F.col("n_words") >= limits.guard_words
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = rows.select(
        *counts,
        F.col("classes")[CLASS_NAMES.index("symbol")].alias("n_symbols"),
        base.alias("base_failed"),
        F.when(long_enough, F.expr(_CLASS_DISTANCE)).alias("class_distance"),
        F.when(long_enough & (F.col("ref_all") > 0), F.expr(_WORD_DISTANCE)).alias("word_distance"),
        _word_limit(limits).alias("word_limit"),
        next_step(),
    )
    slack = F.lit(limits.allowance) / F.greatest("n_words", F.lit(1))
    near = (F.coalesce("class_distance", F.lit(0.0)) <= limits.max_class_distance + slack) & (
        F.coalesce("word_distance", F.lit(0.0)) <= F.col("word_limit")
    )
    return rows.withColumn("kept", at_end(~F.col("base_failed") & (near | ~F.col("fitting")))).drop("step", "fitting", "word_limit")


def keep_good(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The rows that pass, with the columns they came with."""
    return judge(docs, lang_col, text_col, limits).where("kept").select("row.*")
