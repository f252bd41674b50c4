"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every key in the given order. Null keys form one group.

    The filter on ``row_number() = 1`` lets Spark keep one row per key in every map task
    before the shuffle (WindowGroupLimit), so a key holding a third of the log reaches its
    reducer as one row per map task. The order should be total for a repeatable result.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)
