"""Gates that a profile sets beside its thresholds: length, cysteines, hydrophobic share, similarity, gatekeeper, selectivity.

A gate that is violated is told as a flag: ``gate:<name>`` keeps a design out
of the selection, ``look:<name>`` asks for a look.  Thresholds and their flags
``passed_*`` are left alone, so the audit replays them as they are.  What
wasn't measured violates nothing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions import align, metrics, sequences
from sievework.functions import vhh as antibody

HARD = "gate:"
SOFT = "look:"
#: Share of a VHH's framework positions that must have a usual residue; ours, as no value is given.
LEAST_FRAMEWORK = 0.8


def _outside(sequence: Column, bounds) -> Column:
    return ~sequences.length_within(sequence, int(bounds[0]), int(bounds[1]))


def violated(sequence: Column, lowered: Column, profile: dict) -> list[tuple[str, Column]]:
    """(flag, condition) of the gates that a profile sets; ``lowered`` is what ``metrics.lower_keys`` gives."""
    peptide, gate, rules = (profile.get(k) or {} for k in ("peptide_specific", "gatekeeper_alignment", "developability"))
    mini, gpcr = profile.get("minibinder_specific") or {}, profile.get("gpcr_specific") or {}
    counter, vhh = (profile.get("gpcr_specific") or {}).get("counter_screen") or {}, profile.get("vhh_specific") or {}
    value = lambda *names: F.coalesce(*[metrics.value_of(lowered, n) for n in names])
    out: list[tuple[str, Column]] = []
    if bounds := peptide.get("length"):
        out.append((HARD + "length", _outside(sequence, bounds)))
    if bounds := peptide.get("length_sweet_spot"):
        out.append((SOFT + "length_sweet_spot", _outside(sequence, bounds)))
    if (most := peptide.get("natural_similarity_max")) is not None:
        out.append((HARD + "natural_similarity", align.identity(sequence) >= float(most)))
    if rules.get("cys_policy") == "even_count_only":
        out.append((HARD + "odd_cysteines", ~sequences.even_cysteines(sequence)))
    limits = [x for x in (rules.get("max_surface_hydrophobic_frac"), (mini.get("solubility") or {}).get("max_surface_hydrophobic_frac")) if x is not None]
    if limits:
        out.append((HARD + "hydrophobic", sequences.hydrophobic_fraction(sequence) > float(min(limits))))
    if bounds := mini.get("length"):
        out.append((HARD + "minibinder_length", _outside(sequence, bounds)))
    if mini.get("forbid_any_cys"):
        out.append((HARD + "any_cysteine", sequence.contains("C")))
    if (least := (profile.get("folding_confidence") or {}).get("ranking_score_select")) is not None:
        out.append((HARD + "ranking_score", metrics.passes(value("ranking_score"), least, False) == F.lit(False)))
    if gpcr.get("require_pocket_engagement"):
        out.append((HARD + "no_pocket", value("pocket_engagement", "pocket_contacts") <= 0))
    if (most := rules.get("length_synthesizability")) is not None:
        out.append((SOFT + "length_synthesizability", F.length(sequence) > int(most)))
    if (least := gate.get("iptm_complex_min")) is not None:
        out.append((HARD + "iptm_complex", metrics.passes(metrics.resolve(lowered, "i_pTM"), least, False) == F.lit(False)))
    if (least := gate.get("plddt_peptide_min")) is not None:
        out.append((HARD + "plddt_peptide", metrics.passes(metrics.resolve(lowered, "pLDDT_binder"), least, False) == F.lit(False)))
    if gate.get("nka_displacement_check"):
        out.append((HARD + "displacement", value("iptm_ad") >= value("iptm_ab")))
    if (least := counter.get("srs_min")) is not None:
        out.append((HARD + "selectivity", value("srs") < float(least)))
    if (profile.get("gpcr_specific") or {}).get("membrane_clash_check"):
        out.append((HARD + "membrane_clash", value("membrane_clash", "membrane_clashes") > 0))
    if (least := (profile.get("novelty") or {}).get("min_mutations_vs_known_binders")) is not None:
        out.append((HARD + "few_mutations", value("mutations_vs_known") < float(least)))
    if (most := (profile.get("novelty") or {}).get("max_identity_vs_pdb")) is not None:
        out.append((HARD + "known_structure", value("identity_vs_pdb") > float(most)))
    if vhh.get("forbid_unpaired_cys"):
        out.append((HARD + "unpaired_cysteine", ~sequences.even_cysteines(sequence)))
    if (bounds := vhh.get("cdr3_length")) or vhh.get("framework_integrity"):
        found = antibody.annotate(sequence)
    if bounds:
        out.append((HARD + "cdr3_length", ~F.coalesce(value("cdr3_length"), F.length(found["cdr3"])).between(*map(float, bounds))))
    if vhh.get("framework_integrity"):
        out.append((HARD + "framework", found["framework"] < LEAST_FRAMEWORK))
    if "M" in ((vhh.get("liability_scan") or {}).get("oxidation") or ()):
        out.append((SOFT + "oxidation", sequence.contains("M")))
    return out


def flags(sequence: Column, lowered: Column, profile: dict) -> Column:
    """Flags of the violated gates, in fixed order."""
    told = [F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in violated(sequence, lowered, profile)]
    return F.array_compact(F.array(*told)) if told else F.array().cast("array<string>")


def open_to(liability_flags: Column) -> Column:
    """Whether no gate keeps a design with these flags out."""
    return ~F.exists(F.coalesce(liability_flags, F.array().cast("array<string>")), lambda f: f.startswith(HARD))
