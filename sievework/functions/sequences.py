"""Sequence checks as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The 20 natural amino acids.
ALPHABET = "ACDEFGHIKLMNPQRSTVWY"

# Flag, motif it looks for, and whether the profile must forbid the motif by this name.
MOTIFS = (("deamidation_NG", "NG", "NG"), ("deamidation_NS", "NS", "NS"), ("isomerization_DG", "DG", "DG"), ("n_glycosylation", "N[^P][ST]", None))


def liability_flags(sequence: Column, profile: dict) -> Column:
    """Flags of a sequence in fixed order: forbidden motifs, glycosylation sites always, cysteine if forbidden."""
    rules = profile.get("developability") or {}
    forbidden = set(rules.get("forbid_motifs") or ())
    tests = [F.when(sequence.rlike(pattern), F.lit(flag)) for flag, pattern, name in MOTIFS if name is None or name in forbidden]
    if rules.get("forbid_free_cys"):
        tests.append(F.when(sequence.contains("C"), F.lit("cys_present")))
    return F.array_compact(F.array(*tests))


def illegal_characters(sequence: Column, alphabet: str = ALPHABET) -> Column:
    """Sorted different characters outside the alphabet, as one string."""
    chars = F.array_distinct(F.filter(F.split(F.coalesce(sequence, F.lit("")), ""), lambda c: c != ""))
    return F.array_join(F.array_sort(F.array_except(chars, F.split(F.lit(alphabet), ""))), "")


def even_cysteines(sequence: Column) -> Column:
    """Whether the cysteines can all pair up."""
    return F.regexp_count(sequence, F.lit("C")) % 2 == 0


def length_within(sequence: Column, low: int, high: int) -> Column:
    return F.length(sequence).between(low, high)


def hydrophobic_fraction(sequence: Column) -> Column:
    """Share of A, F, I, L, M, V, W among the residues; an extension of ours."""
    return F.regexp_count(sequence, F.lit("[AFILMVW]")) / F.nullif(F.length(sequence), F.lit(0))
