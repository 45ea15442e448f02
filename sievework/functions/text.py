"""Column expressions on text, JVM-side only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of the word definition ``[^\x20\x09-\x0D]+``, without the blank.
SPACES = "\t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null text: empty array."""
    blank = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(blank, " "), "")


def count_words(text: Column) -> Column:
    """Number of words of a text as a long; null text: 0."""
    return F.size(words(text)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` bound once, so that lambdas inside don't evaluate it again for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)
