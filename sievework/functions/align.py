"""Identity of a sequence with a reference by local alignment.

Match 1, mismatch -1, a gap's first symbol -2 and each further one -0.5.
Of equally good alignments the longest counts, and of those the one with
most matches.  Under ``MIN_COLUMNS`` columns there's no hit, identity 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_COLUMNS = 7
#: The natural peptide that candidates are held against.
REFERENCE = "HKTDSFVGLM"


#: A score in halves, the columns and the matches of an alignment in one number, which orders them so.
_HALF, _COLUMN, _MATCH, _NONE = 1 << 40, 1 << 20, 1, -(1 << 60)


def _codes(texts: list[str], padding: int) -> np.ndarray:
    out = np.full((len(texts), max(map(len, texts), default=0)), padding, dtype=np.int64)
    for k, text in enumerate(texts):
        out[k, : len(text)] = [ord(c) for c in text]
    return out


def local_identities(queries: list[str | None], references: list[str | None]) -> np.ndarray:
    """Matches by columns of the best local alignment of each pair; 0 for a short or missing one.

    All pairs are aligned at once, cell by cell; what pads shorter ones
    matches nothing, so it never adds to the best.
    """
    q, r = _codes([x or "" for x in queries], -1), _codes([x or "" for x in references], -2)
    many, width = len(q), r.shape[1] + 1
    opened, longer = _COLUMN - 4 * _HALF, _COLUMN - _HALF
    best = np.zeros(many, dtype=np.int64)
    met = [np.zeros(many, dtype=np.int64) for _ in range(width)]
    gap_q, gap_r = ([np.full(many, _NONE, dtype=np.int64) for _ in range(width)] for _ in range(2))
    for i in range(q.shape[1]):
        new_met, new_q, new_r = [np.zeros(many, dtype=np.int64)], [np.full(many, _NONE, dtype=np.int64)], [np.full(many, _NONE, dtype=np.int64)]
        for j in range(1, width):
            before = np.maximum(np.maximum(met[j - 1], gap_q[j - 1]), np.maximum(gap_r[j - 1], 0))
            here = before + np.where(q[:, i] == r[:, j - 1], 2 * _HALF + _COLUMN + _MATCH, _COLUMN - 2 * _HALF)
            new_met.append(np.where(here >= _HALF, here, 0))
            new_r.append(np.maximum(np.maximum(met[j], gap_q[j]) + opened, gap_r[j] + longer))
            new_q.append(np.maximum(np.maximum(new_met[j - 1], new_r[j - 1]) + opened, new_q[j - 1] + longer))
            best = np.maximum(best, here)
        met, gap_q, gap_r = new_met, new_q, new_r
    columns, matches = best % _HALF // _COLUMN, best % _COLUMN
    return np.where(columns >= MIN_COLUMNS, matches / np.maximum(columns, 1), 0.0)


def local_identity(query: str | None, reference: str = REFERENCE) -> float:
    """``local_identities`` of one pair."""
    return float(local_identities([query], [reference])[0])


#: Pairs that are aligned at once.
AT_ONCE = 2_048


@F.pandas_udf(T.DoubleType())
def _identity(query: pd.Series, reference: pd.Series) -> pd.Series:
    pairs = [(q if isinstance(q, str) else None, r if isinstance(r, str) else None) for q, r in zip(query, reference, strict=True)]
    different = sorted(set(pairs), key=lambda p: (len(p[0] or ""), len(p[1] or ""), str(p)))
    known: dict = {}
    for at in range(0, len(different), AT_ONCE):
        part = different[at : at + AT_ONCE]
        known.update(zip(part, local_identities(*map(list, zip(*part, strict=True))), strict=True))
    return pd.Series([known[p] for p in pairs], dtype="float64")


def identity(query: Column, reference: Column | str = REFERENCE) -> Column:
    """``local_identity`` on columns."""
    return _identity(query, reference if isinstance(reference, Column) else F.lit(reference))


def differs_enough(query: Column, most: float = 0.30) -> Column:
    """(accepted, identity rounded to three digits); the limit holds for the unrounded value."""
    found = identity(query)
    return F.struct((found < most).alias("accepted"), F.bround(found, 3).alias("identity"))
