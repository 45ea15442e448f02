"""Column names beside a caller's own."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(taken: DataFrame | Iterable[str], *wanted: str) -> list[str]:
    """Names like ``wanted`` that no column of ``taken`` has, in any case."""
    used = {c.lower() for c in (taken.columns if isinstance(taken, DataFrame) else taken)}
    out = []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out
