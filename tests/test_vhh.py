"""Loops of VHHs against a plain alignment; gates of profiles; quantiles against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.functions import metrics, stats, vhh
from sievework.operators import gates, rank
from sievework.sources.registry import Registry

#: A public therapeutic VHH and a common scaffold, with their third loops.
KNOWN = {
    "EVQLVESGGGLVQPGGSLRLSCAASGRTFSYNPMGWFRQAPGKGRELVAAISRTGGSTYYPDSVEGRFTISRDNAKRMVYLQMNSLRAEDTAVYYCAAAGVRAEDGRVRTLPSEYTFWGQGTQVTVSS": "AAAGVRAEDGRVRTLPSEYTF",
    "QVQLVESGGGLVQAGGSLRLSCAASGFPVNRYSMRWYRQAPGKEREWVAGMSSAGDRSSYEDSVKGRFTISRDDARNTVYLQMNSLKPEDTAVYYCNVNVGFEYWGQGTQVTVSS": "NVNVGFEY",
}


def plain_align(s):
    """The score of the best alignment by a plain table."""
    usual, ends = vhh.positions()
    free = {0, *ends}
    now = [0.0] * (len(s) + 1)
    for j, letters in enumerate(usual, 1):
        new = []
        for i in range(len(s) + 1):
            best = now[i] - vhh.GAP
            if i:
                hit = s[i - 1] in letters
                best = max(best, now[i - 1] + (vhh.CONSERVED if hit and letters in ("C", "W") else vhh.USUAL if hit else vhh.OTHER), new[i - 1] - (0 if j in free else vhh.GAP))
            new.append(best)
        now = new
    return now[-1]


def score_of(s, at):
    """The score of given places."""
    usual, ends = vhh.positions()
    total = -vhh.GAP * int((at < 0).sum())
    for p, letters in zip(at, usual, strict=True):
        if p >= 0:
            total += vhh.CONSERVED if s[p] in letters and letters in ("C", "W") else vhh.USUAL if s[p] in letters else vhh.OTHER
    for j in range(1, len(usual)):
        if j not in ends and at[j] >= 0:
            before = [p for p in at[:j] if p >= 0]
            inner = [k for k in range(j) if at[k] >= 0]
            if before and not any(inner[-1] < e <= j for e in ends):
                total -= vhh.GAP * (at[j] - before[-1] - 1)
    return total


def test_alignment_is_the_best_and_finds_known_loops(spark):
    for s, cdr3 in KNOWN.items():
        found = vhh.loops([s])[0]
        assert found[2] == cdr3 and found[3] > 0.8 and all(found[:3]), found
    rng = random.Random(1)
    made = []
    for s in list(KNOWN) * 6:
        out = list(s)
        for _ in range(rng.randint(0, 12)):
            at = rng.randrange(len(out))
            out[at : at + rng.randint(0, 1)] = rng.choice(vhh.LETTERS + "X") * rng.randint(0, 2)
        made.append("".join(out))
    made += ["A", "WWWW", "ACDEFGHIKLMNPQRSTVWY" * 8, "MKK" + next(iter(KNOWN)) + "HHHHHH"]
    for s, at in zip(made, vhh.align(made), strict=True):
        assert list(at[at >= 0]) == sorted(set(at[at >= 0])) and score_of(s, at) == pytest.approx(plain_align(s))
    rows = spark.createDataFrame([(s,) for s in (*KNOWN, None, "", "A" * 3000)], "s string").select("s", vhh.annotate(F.col("s")).alias("v")).collect()
    assert [r["v"]["cdr3"] if r["v"] else None for r in rows] == [*KNOWN.values(), None, None, None]


def flagged(spark, sequence, profile, **values):
    row = spark.createDataFrame([(sequence, values or {"x": 0.0})], "s string, m map<string,double>")
    return row.select(gates.flags(F.col("s"), metrics.lower_keys(F.col("m")), profile).alias("f")).first()["f"]


def test_gates_of_vhh_minibinder_and_peptide_profiles(spark):
    profile = {"vhh_specific": {"framework_integrity": True, "cdr3_length": [9, 22]}}
    long, short = KNOWN
    assert flagged(spark, long, profile) == [] and flagged(spark, short, profile) == ["gate:cdr3_length"]
    assert flagged(spark, short, profile, cdr3_length=10.0) == []
    assert "gate:framework" in flagged(spark, "ACDEFGHIKL" * 12, profile)
    mini = {"developability": {"max_surface_hydrophobic_frac": 0.5}, "minibinder_specific": {"length": [5, 9], "forbid_any_cys": True, "solubility": {"max_surface_hydrophobic_frac": 0.3}}}
    assert flagged(spark, "GGGGG", mini) == [] and flagged(spark, "GGC", mini) == ["gate:minibinder_length", "gate:any_cysteine"] and flagged(spark, "GGGVVL", mini) == ["gate:hydrophobic"]
    other = {"folding_confidence": {"ranking_score_select": 0.8}, "gpcr_specific": {"require_pocket_engagement": True}}
    assert flagged(spark, "G", other, ranking_score=0.7, pocket_contacts=0.0) == ["gate:ranking_score", "gate:no_pocket"]
    assert flagged(spark, "G", other, ranking_score=0.8) == []


def test_selectivity_takes_its_share_of_the_score(spark):
    rows = spark.createDataFrame([({"srs": 0.5},), ({"srs": 3.0},), ({"srs": -1.0},), ({"a": 1.0},), ({"srs": float("nan")},)], "m map<string,double>")
    got = lambda target: [r[0] for r in rows.select(rank.with_selectivity(F.lit(0.8), metrics.lower_keys(F.col("m")), target)).collect()]
    rule = {"selectivity_score": {"enabled": True, "weight_in_final": 0.35}}
    assert got(rule) == pytest.approx([0.8 * 0.65 + 0.35 * x for x in (0.5, 1, 0, 0, 0)])
    assert got({}) == got({"selectivity_score": {"enabled": False, "weight_in_final": 0.35}}) == [0.8] * 5


def test_a_row_without_id_gets_one(spark, tmp_path):
    r = Registry(spark, str(tmp_path / "r"))
    fields = {"target_id": "t", "modality": "m", "pipeline": "p", "config_hash": "h", "sequence": "A", "length": 1}
    r.upsert_many([fields, fields | {"design_id": "x"}])
    r.upsert(spark.createDataFrame([tuple(fields.values())], list(fields)))
    ids = {x["design_id"] for x in r.read().collect()}
    assert len(ids) == 3 and "x" in ids and all(len(i) == 12 and int(i, 16) >= 0 for i in ids - {"x"})


def test_quantiles_and_top_shares_equal_numpy(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([1.0, 2.5, 2.5, rng.random() * 9, None]), i) for i in range(500)] + [("one", 7.0, 900), ("none", None, 901)]
    df = spark.createDataFrame(rows, "g string, v double, i long")
    at = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
    got = {(r["g"], r["at"]): (r["quantile"], r["total"]) for r in stats.quantiles(df, ["g"], "v", at).collect()}
    groups = {g: [v for h, v, _ in rows if h == g and v is not None] for g in ("a", "b", None, "one")}
    assert got == {(g, p): (pytest.approx(np.quantile(v, p)), len(v)) for g, v in groups.items() for p in at}
    assert stats.quantiles(df.where("false"), ["g"], "v", at).isEmpty() and stats.quantiles(df.where("g = 'none'"), [], "v", at).isEmpty()
    top = {r["i"] for r in stats.top_share(df, ["g"], [F.coalesce(-F.col("v"), F.lit(99.0)), F.col("i")], 0.1).collect()}
    want = set()
    for g in {r[0] for r in rows}:
        mine = sorted((99.0 if v is None else -v, i) for h, v, i in rows if h == g)
        want |= {i for _, i in mine[: -(-len(mine) // 10)]}
    assert top == want
    row = stats.describe(df, "v").first()
    assert row["q50"] == pytest.approx(np.median([v for _, v, _ in rows if v is not None])) and row["n"] == sum(v is not None for _, v, _ in rows)
