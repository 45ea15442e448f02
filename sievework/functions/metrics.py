"""Metric names, directions and thresholds as column expressions.

A metric that wasn't measured abstains: it neither passes nor fails.  NaN
was measured and passes no threshold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metrics for which a lower value is better, in lower case.
LOWER_IS_BETTER = frozenset({"i_pae", "ipae", "monomer_rmsd_a", "monomer_rmsd", "rmsd", "interface_energy", "min_interface_energy"})

# Names under which a record may hold a threshold's metric, first found counts.
CANDIDATES = {
    "pLDDT_binder": ("pLDDT_binder", "plddt_binder", "pLDDT", "plddt"),
    "i_pTM": ("i_pTM", "iptm", "i_ptm"),
    "i_PAE": ("i_PAE", "i_pae", "ipae"),
    "monomer_rmsd_A": ("monomer_rmsd_A", "RMSD", "rmsd"),
    "buried_sasa_A2": ("buriedSASA", "buried_sasa", "buried_sasa_A2"),
    "interface_hbonds": ("interface_hbonds", "hbonds"),
    "min_interface_energy": ("interface_energy", "min_interface_energy"),
    "boltz2_affinity_prob": ("boltz2_prob", "boltz2_affinity_prob", "affinity_prob"),
}
SECTIONS = ("folding_confidence", "interface_physics")


def lower_is_better(key: str, directions: dict[str, str] | None = None) -> bool:
    """Direction of a metric; ``directions`` may override it with "lower" or "higher"."""
    told = {k.lower(): v for k, v in (directions or {}).items()}.get(key.lower())
    return told == "lower" if told else key.lower() in LOWER_IS_BETTER


def lower_keys(metrics: Column) -> Column:
    """A metric map as a struct of its names in lower case and their values, last entry first.

    Of names that differ in case only the last entry is thus found first.
    """
    known = F.coalesce(metrics, F.create_map().cast("map<string,double>"))
    return F.struct(F.reverse(F.transform(F.map_keys(known), F.lower)).alias("names"), F.reverse(F.map_values(known)).alias("values"))


def value_of(lowered: Column, name: str) -> Column:
    """Value of a lower-case name; null if it isn't there."""
    return F.get(lowered["values"], F.array_position(lowered["names"], F.lit(name)).cast("int") - 1)


def resolve(lowered: Column, key: str) -> Column:
    """Value of a threshold's metric; null if none of its names is there."""
    names = list(dict.fromkeys(c.lower() for c in CANDIDATES.get(key, (key,))))
    return F.coalesce(*[value_of(lowered, n) for n in names])


def passes(value: Column, threshold: float | Column | None, lower: bool) -> Column:
    """Whether a value meets a threshold, inclusively; null where either is missing; false for NaN.

    The value is named once: NaN is greater than any number, so where lower
    is better it fails by itself, and else it is read as less than any.
    """
    if threshold is None:
        return F.lit(None).cast("boolean")
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (value <= t) if lower else (F.nanvl(value.cast("double"), F.lit(float("-inf"))) >= t)


def specs(profile: dict, level: str, sections: tuple[str, ...] = SECTIONS) -> list[tuple[str, float | None]]:
    """(metric, threshold) of a profile's level; disabled ones and those without the level are left out."""
    out = {}
    for section in sections:
        for key, spec in (profile.get(section) or {}).items():
            if isinstance(spec, dict) and level in spec and spec.get("enabled") is not False:
                out[key] = spec[level]
    return list(out.items())


def bind(df: DataFrame, metrics: Column, profile: dict, name: str = "_bound") -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with the values of all metrics that a profile names, and these by metric.

    Each value is searched for once a row, however many levels are compared.
    """
    keys = sorted({k for section in SECTIONS for k, spec in (profile.get(section) or {}).items() if isinstance(spec, dict)})
    if not keys:
        return df, {}
    held = df.withColumn(name, F.struct(*[resolve(metrics, k).alias(f"v{i}") for i, k in enumerate(keys)]))
    return held, {k: F.col(f"{name}.v{i}") for i, k in enumerate(keys)}


def verdicts(metrics: Column | dict[str, Column], profile: dict, level: str, sections: tuple[str, ...] = SECTIONS) -> list[tuple[str, Column, Column]]:
    """(metric, value, pass) columns of a level; ``metrics`` is what ``lower_keys`` or ``bind`` gives."""
    directions = profile.get("direction")
    out = []
    for key, threshold in specs(profile, level, sections):
        value = metrics[key] if isinstance(metrics, dict) else resolve(metrics, key)
        out.append((key, value, passes(value, threshold, lower_is_better(key, directions))))
    return out


def threshold_report(metrics: Column | dict[str, Column], profile: dict, level: str) -> Column:
    """Array of (key, threshold, value, pass) for every threshold of a level."""
    limits = dict(specs(profile, level))
    rows = [
        F.struct(F.lit(k).alias("key"), F.lit(limits[k]).cast("double").alias("threshold"), v.cast("double").alias("value"), p.alias("pass"))
        for k, v, p in verdicts(metrics, profile, level)
    ]
    return F.array(*rows) if rows else F.array().cast("array<struct<key:string,threshold:double,value:double,pass:boolean>>")


def min_agreeing(profile: dict) -> int | None:
    """How many predictors must agree, if the profile says so."""
    n = ((profile.get("folding_confidence") or {}).get("cross_predictor") or {}).get("min_agreeing")
    return n if isinstance(n, int) else None


def passes_level(metrics: Column | dict[str, Column], agreeing: Column, profile: dict, level: str) -> Column:
    """No measured metric fails and enough predictors agree; a null count is none."""
    tests = [F.coalesce(p, F.lit(True)) for _, _, p in verdicts(metrics, profile, level)]
    if (n := min_agreeing(profile)) is not None:
        tests.append(F.coalesce(agreeing, F.lit(0)) >= n)
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def failed_keys(metrics: Column | dict[str, Column], profile: dict, level: str) -> Column:
    """Names of the thresholds that fail."""
    return F.array_compact(F.array(*[F.when(~p, F.lit(k)) for k, _, p in verdicts(metrics, profile, level)], F.lit(None).cast("string")))


def agree_simple(by_predictor: Column, key: str = "i_pTM", least: float = 0.5) -> Column:
    """Predictors whose ``key`` reaches ``least`` in a map of metric maps; missing counts as zero."""
    values = F.map_values(F.coalesce(by_predictor, F.create_map().cast("map<string,map<string,double>>")))
    return F.size(F.filter(values, lambda m: F.coalesce(F.try_element_at(m, F.lit(key)), F.lit(0.0)) >= least))


def selectivity(on: Column, *off: Column) -> Column:
    """On-target score less the best off-target score."""
    return on - (F.greatest(*off) if len(off) > 1 else off[0])
