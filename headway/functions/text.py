"""Cleaning of feed strings and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode White_Space characters. Spark's own trim() takes only U+0020.
ASCII_SPACE = "\u0020\u0009\u000a\u000b\u000c\u000d"
WHITE_SPACE = (
    ASCII_SPACE
    + "\u0085\u00a0\u1680"
    + "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    + "\u2028\u2029\u202f\u205f\u3000"
)


def trimmed(name: str) -> Column:
    """Text without white space at its ends.

    The cost of a trim grows with its set of characters, so text of plain ASCII, nearly all
    of a feed, is not tested for the others.
    """
    text = F.col(name)
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.btrim(text, F.lit(ASCII_SPACE))).otherwise(F.btrim(text, F.lit(WHITE_SPACE)))


def clean_text(name: str) -> Column:
    """Trimmed text, null when nothing is left."""
    return F.nullif(trimmed(name), F.lit(""))


def has_text(name: str) -> Column:
    """True where ``clean_text`` is not null; cheaper to test before a projection."""
    return trimmed(name) != ""


def zero_to_null(value: Column) -> Column:
    """Feed numbers use 0 for 'not set'."""
    return F.nullif(value, F.lit(0))
