"""Words and column helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space that separates words, as characters and as a pattern.
SPACE_CHARS = "\x20\x09\x0a\x0b\x0c\x0d"
SPACES = r"[\x20\x09-\x0D]+"


def whole(text: str = "text") -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs without white space, in order."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def packed(df: DataFrame, **computed: Column) -> DataFrame:
    """The given columns beside all columns of ``df`` in one struct ``row``.

    Operators that return rows as they came use it, so that no input column can clash with
    one of theirs; ``unpacked`` restores the rows.
    """
    return df.select(F.struct(*(_named(df, c) for c in df.columns)).alias("row"), *(v.alias(k) for k, v in computed.items()))


def by_shuffle(side: DataFrame) -> DataFrame:
    """The side of a join that is never broadcast. The planner sizes a table by its files, in which
    ids and lists shrink a hundredfold, and a list by one element, also once it is exploded; what
    it takes for small may not fit the driver."""
    return side.hint("merge")


def _named(df: DataFrame, name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


# The planner merges neighbouring projections and pushes filters below them, and so copies an
# expression to every place that mentions it: inside a lambda it is then evaluated per
# element, and in a chain the copies multiply. It leaves a projection alone whose columns it
# may not copy, such as one that depends on the partition. ``first_step`` begins such a
# column, every further projection of a chain renews it with ``next_step``, and the last
# result mentions it with ``at_end``.


def first_step() -> Column:
    return F.spark_partition_id().alias("step")


def next_step() -> Column:
    return F.col("step").bitwiseOR(F.spark_partition_id()).alias("step")


def at_end(result: Column) -> Column:
    return F.when(F.col("step") >= 0, result)
