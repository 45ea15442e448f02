"""Framework and loops of a VHH from its sequence alone: alignment to a table of framework positions.

A position of the table names the residues that are usual there; one of them
scores 1, a conserved cysteine or tryptophan 3, another residue -1.  Within a
framework a residue too many or too few costs 2; between frameworks, where
the three loops are, residues are free, as they are before the first and
after the last position.  Of equally good alignments a residue is rather
placed than left out.  A batch of sequences is aligned at once, position by
position.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Usual residues at the positions of the four frameworks; a class in brackets is one position.
FRAMEWORKS = (
    "[QED]VQL[VQ][EQ][ST]GGG[LSV]VQ[APT]G[GD][ST]LRLSC[ATVE][AV][ST]",
    "W[YFV]RQ[AT]PG[KN][EGQ][RL][EL][FWLG]V[AS]",
    "[YN][AYSP][DEP][ST][VA][KEQR]GRF[TA]I[SA][RQ]D[NS][AS][KER][NRK][TMS][VLM][YFD]LQM[NDS][SN]L[KR][PAST]ED[TS]A[VTMLI]Y[YF]C",
    "W[GS][QKRP]GT[QLM]VTVSS",
)
LETTERS = "ACDEFGHIKLMNPQRSTVWY"
USUAL, CONSERVED, OTHER, GAP = 1.0, 3.0, -1.0, 2.0
#: Longest sequence that is aligned; a single domain has about 130 residues.
LONGEST = 2_000
SCHEMA = T.StructType([*[T.StructField(f"cdr{i}", T.StringType()) for i in (1, 2, 3)], T.StructField("framework", T.DoubleType())])


def positions() -> tuple[list[str], list[int]]:
    """(usual residues of each position, number of positions up to the end of each framework)."""
    parts = [re.findall(r"\[\w+\]|\w", f) for f in FRAMEWORKS]
    return [x.strip("[]") for p in parts for x in p], list(np.cumsum([len(p) for p in parts]))


def _scores(usual: list[str]) -> np.ndarray:
    """Score of each position and letter; the last column is for any other letter."""
    out = np.full((len(usual), len(LETTERS) + 1), OTHER)
    for j, letters in enumerate(usual):
        for x in letters:
            out[j, LETTERS.index(x)] = CONSERVED if letters in ("C", "W") else USUAL
    return out


def align(sequences: list[str]) -> np.ndarray:
    """Index of the residue at each position of each sequence; -1 where there is none."""
    usual, ends = positions()
    scores, many, longest = _scores(usual), len(sequences), max(map(len, sequences), default=0)
    free = np.zeros(len(usual) + 1, dtype=bool)
    free[[0, *ends]] = True
    codes = np.full((many, longest), -1)
    for k, s in enumerate(sequences):
        codes[k, : len(s)] = [LETTERS.find(c) for c in s]
    length = np.array([len(s) for s in sequences])
    best, moves = np.zeros((many, longest + 1)), np.zeros((len(usual) + 1, many, longest + 1), dtype=np.int8)
    moves[0] = 2
    for j in range(1, len(usual) + 1):
        placed = np.full((many, longest + 1), -np.inf)
        placed[:, 1:] = best[:, :-1] + scores[j - 1][codes]
        new = np.maximum(placed, best - GAP)
        moves[j] = np.where(placed >= best - GAP, 0, 1)
        for i in range(1, longest + 1):
            passed = new[:, i - 1] - (0.0 if free[j] else GAP)
            more = passed > new[:, i]
            new[more, i] = passed[more]
            moves[j][more, i] = 2
        best = new
    where = np.full((many, len(usual)), -1)
    j, i, rows = np.full(many, len(usual)), length.copy(), np.arange(many)
    while (live := j > 0).any():
        move = moves[j, rows, i]
        put = live & (move == 0)
        where[rows[put], j[put] - 1] = i[put] - 1
        j = j - (live & (move < 2))
        i = i - (live & (move != 1))
    return where


def loops(sequences: list[str | None]) -> list[tuple | None]:
    """(cdr1, cdr2, cdr3, share of framework positions with a usual residue) of each sequence; a loop is null where a position beside it has no residue."""
    usual, ends = positions()
    known = [k for k, s in enumerate(sequences) if s and len(s) <= LONGEST]
    out: list[tuple | None] = [None] * len(sequences)
    if not known:
        return out
    for k, at in zip(known, align([sequences[k] for k in known]), strict=True):
        text = sequences[k]
        parts = [text[at[e - 1] + 1 : at[e]] if at[e - 1] >= 0 and at[e] >= 0 else None for e in ends[:3]]
        fine = sum(p >= 0 and text[p] in letters for p, letters in zip(at, usual, strict=True))
        out[k] = (*parts, fine / len(usual))
    return out


@F.pandas_udf(SCHEMA)
def _annotated(sequence: pd.Series) -> pd.DataFrame:
    different = {s: None for s in sequence if isinstance(s, str)}
    for at in range(0, len(different), 256):  # few alignments are held at once
        part = sorted(different, key=len)[at : at + 256]
        different.update(zip(part, loops(part), strict=True))
    rows = [different.get(s) or (None,) * 4 for s in sequence]
    return pd.DataFrame(rows, columns=SCHEMA.names)


def annotate(sequence: Column) -> Column:
    """(cdr1, cdr2, cdr3, framework) of a sequence; all null for a null, empty or longer one."""
    return _annotated(sequence)
