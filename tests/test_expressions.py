import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework import queries
from sievework.functions import align, metrics, sequences, stats
from sievework.operators import rank

PROFILE = {
    "folding_confidence": {"pLDDT_binder": {"screen": 75, "select": 80}, "i_PAE": {"screen": 0.35}, "cross_predictor": {"min_agreeing": 2}},
    "interface_physics": {"dG_separated": {"screen": -20, "enabled": False}, "interface_hbonds": {"screen": None, "select": 3}},
}


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def map_of(values: dict):
    pairs = [x for k, v in values.items() for x in (F.lit(k), F.lit(v).cast("double"))]
    return F.create_map(*pairs).cast("map<string,double>") if pairs else F.create_map().cast("map<string,double>")


@pytest.mark.parametrize(
    ("values", "agreeing", "level", "expected"),
    [
        ({"pLDDT": 75.0, "iPAE": 0.35}, 2, "screen", True),  # limits are inclusive
        ({"PLDDT": 74.9}, 2, "screen", False),
        ({}, 2, "screen", True),  # unmeasured metrics abstain
        ({"i_pae": 0.4}, 2, "screen", False),  # lower is better
        ({"plddt": float("nan")}, 2, "screen", False),  # NaN passes nothing
        ({"plddt": 90.0}, 1, "screen", False),
        ({"plddt": 90.0}, None, "screen", False),
        ({"plddt": 90.0, "hbonds": 2.0}, 2, "select", False),
        ({"plddt": 90.0, "dG_separated": 5.0}, 2, "screen", True),  # disabled
    ],
)
def test_levels(spark, values, agreeing, level, expected):
    low = metrics.lower_keys(map_of(values))
    assert one(spark, metrics.passes_level(low, F.lit(agreeing).cast("int"), PROFILE, level)) is expected


def test_report_and_names(spark):
    low = metrics.lower_keys(map_of({"A": 1.0, "pLDDT": 70.0, "plddt_binder": 90.0}))
    report = {r["key"]: r for r in one(spark, metrics.threshold_report(low, PROFILE, "screen"))}
    assert report["pLDDT_binder"]["value"] == 90.0 and report["pLDDT_binder"]["pass"] is True
    assert report["i_PAE"]["pass"] is None and report["interface_hbonds"]["pass"] is None and "dG_separated" not in report
    assert one(spark, metrics.value_of(metrics.lower_keys(map_of({"A": 1.0, "a": 2.0})), "a")) == 2.0
    assert one(spark, metrics.value_of(metrics.lower_keys(F.lit(None).cast("map<string,double>")), "a")) is None
    assert metrics.lower_is_better("I_PAE") and not metrics.lower_is_better("dG_separated") and metrics.lower_is_better("dG_separated", {"dg_separated": "lower"})


def test_agreement_and_selectivity(spark):
    by = F.from_json(F.lit('{"a": {"i_pTM": 0.5}, "b": {"i_pTM": 0.49}, "c": {}}'), "map<string,map<string,double>>")
    assert one(spark, metrics.agree_simple(by)) == 1
    assert one(spark, metrics.agree_simple(F.lit(None).cast("map<string,map<string,double>>"))) == 0
    assert one(spark, metrics.selectivity(F.lit(0.9), F.lit(0.2), F.lit(0.5))) == pytest.approx(0.4)


def test_sequence_flags(spark):
    rules = {"developability": {"forbid_motifs": ["NG", "DG"], "forbid_free_cys": True}}
    assert one(spark, sequences.liability_flags(F.lit("NGSNSCDGNAT"), rules)) == ["deamidation_NG", "isomerization_DG", "n_glycosylation", "cys_present"]
    assert one(spark, sequences.liability_flags(F.lit("NPT"), {})) == [] and one(spark, sequences.liability_flags(F.lit("NAT"), {})) == ["n_glycosylation"]
    assert one(spark, sequences.illegal_characters(F.lit("ACXZBXa"))) == "BXZa" and one(spark, sequences.illegal_characters(F.lit(None).cast("string"))) == ""
    assert one(spark, sequences.even_cysteines(F.lit("CAC"))) is True and one(spark, sequences.hydrophobic_fraction(F.lit("AADD"))) == 0.5


@pytest.mark.parametrize(
    ("text", "accepted"),
    [("HKTDSFVGLM", False), ("HKTDSFVGLMGG", False), ("CPYTKLNRCCFYFLM", True), ("GFPCFYFLM", True), ("CFYFLM", True), ("CQRFRPGKCCFYFLM", True), ("AAAAAAAAAA", True), ("", True), (None, True)],
)
def test_similarity_to_the_natural_peptide(text, accepted):
    assert (align.local_identity(text) < 0.30) is accepted


def brute_identity(q, r):
    """All alignments of all pieces, by exhaustive recursion."""
    best = (0.0, 0, 0)

    def walk(i, j, state, score, cols, same):
        nonlocal best
        if state == "m":
            best = max(best, (score, cols, same))
        if i < len(q) and j < len(r):
            walk(i + 1, j + 1, "m", score + (1 if q[i] == r[j] else -1), cols + 1, same + (q[i] == r[j]))
        if i < len(q):
            walk(i + 1, j, "q", score - (0.5 if state == "q" else 2), cols + 1, same)
        if j < len(r):
            walk(i, j + 1, "r", score - (0.5 if state == "r" else 2), cols + 1, same)

    for i in range(len(q)):
        for j in range(len(r)):
            walk(i + 1, j + 1, "m", 1.0 if q[i] == r[j] else -1.0, 1, int(q[i] == r[j]))
    return best


def test_local_identity_against_all_alignments():
    rng = random.Random(4)
    for _ in range(60):
        q, r = ("".join(rng.choice("AB") for _ in range(rng.randint(1, 5))) for _ in range(2))
        score, cols, same = brute_identity(q, r)
        old, align.MIN_COLUMNS = align.MIN_COLUMNS, 1
        try:
            found = align.local_identity(q, r)
        finally:
            align.MIN_COLUMNS = old
        assert found == pytest.approx(same / cols if cols and score > 0 else 0.0), (q, r)


def test_statistics(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 30) / 10, rng.random() < 0.3) for _ in range(500)] + [(None, True), (1.0, None)]
    df = spark.createDataFrame([(x, None if y is None else int(y)) for x, y in rows], "x double, y int").repartition(5)
    known = [(x, y) for x, y in rows if x is not None and y is not None]
    pos, neg = [x for x, y in known if y], [x for x, y in known if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    assert stats.auc(df, "x", "y").first()["auc"] == pytest.approx(wins)
    curve = {r["score"]: (r["tp"], r["fp"]) for r in stats.roc_curve(df, "x", "y").collect()}
    assert all(curve[s] == (sum(p >= s for p in pos), sum(n >= s for n in neg)) for s in curve) and len(curve) == len({x for x, _ in known})
    assert stats.auc(df.where("y = 1"), "x", "y").first()["auc"] is None
    hist = {r["bin"]: r["n"] for r in stats.histogram(df, "x", 3).collect()}
    assert sum(hist.values()) == 501 and set(hist) == {1, 2, 3}
    assert stats.enrichment(df.where("y is not null and x is not null"), "x", "y", [0.0, 99.0]).collect()[0]["lift"] == pytest.approx(1.0)


def test_round_robin_and_apportioning(spark):
    rows = [(f"d{c}{i}", c, 10.0 * c - i) for c in range(5) for i in range(6)]
    df = spark.createDataFrame(rows, "design_id string, cluster_id int, final_score double")
    got = [r["design_id"] for r in rank.round_robin(df, 7).collect()]
    assert set(got[:5]) == {"d00", "d10", "d20", "d30", "d40"} and set(got) - set(got[:5]) == {"d41", "d31"}
    held = {r["design_id"] for r in rank.round_robin(df, 4, reserve=0.25).collect()}
    assert held == {"d40", "d30", "d20", "d00"}
    assert rank.apportion(10, {"a": 0.5, "b": 0.25, "c": 0.25}) == {"a": 5, "b": 3, "c": 2} and sum(rank.apportion(7, {"a": 1, "b": 1}).values()) == 7


def test_leaders_against_a_loop(spark):
    rng = random.Random(8)
    items = [(i, rng.random()) for i in range(60)]
    pairs = [(a, b, rng.random()) for a in range(60) for b in range(a + 1, 60) if rng.random() < 0.15]
    got = {r["id"]: r["cluster"] for r in rank.leader_clusters(spark.createDataFrame(pairs, "a long, b long, similarity double"), spark.createDataFrame(items, "id long, score double"), 0.5).collect()}
    sim = {frozenset(p[:2]): p[2] for p in pairs if p[2] >= 0.5}
    want = {}
    for i, _ in sorted(items, key=lambda x: -x[1]):
        leaders = [(sim[frozenset((i, j))], s, j) for j, s in items if want.get(j) == j and frozenset((i, j)) in sim]
        want[i] = max(leaders)[2] if leaders else i
    assert got == want


def test_similar_pairs_of_whole_blocks(spark, monkeypatch):
    monkeypatch.setattr(rank, "TILE", 7)  # many tiles
    rng = np.random.default_rng(3)
    v = rng.normal(size=(60, 8)).astype("float32")
    v[5] = 0
    rows = [(i, v[i].tolist(), i % 2) for i in range(60)] + [(90, None, 0), (91, [1.0], 0), (92, v[1].tolist(), None), (None, v[0].tolist(), 0)]
    df = spark.createDataFrame(rows, "id long, v array<float>, label int")
    got = {(r["a"], r["b"]): r["similarity"] for r in rank.similar_pairs(df, ["label"], 0.2).collect()}
    unit = v / np.maximum(np.linalg.norm(v.astype(float), axis=1), 1e-9)[:, None]
    want = {(a, b): float(unit[a] @ unit[b]) for a in range(60) for b in range(a + 2, 60, 2) if unit[a] @ unit[b] >= 0.2}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_leaders_use_the_pairs_of_whole_labels(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r["vec_id"]: r for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    cluster = {r["id"]: r["cluster"] for r in queries.leader_clusters(spark, sf).collect()}
    unit = {i: (lambda x: x / np.linalg.norm(x))(np.array(r["embedding"], dtype=float)) for i, r in rows.items()}
    leaders = [i for i in cluster if cluster[i] == i]
    assert set(cluster) == set(rows)
    assert not [(i, j) for i in leaders for j in leaders if i < j and rows[i]["label"] == rows[j]["label"] and unit[i] @ unit[j] >= 0.2]


def test_forest_of_tiles_lists_few_pairs_and_links_the_same(spark):
    rows = [(i, [1.0, i / 400, (i * 7 % 11) / 30], "x") for i in range(200)]
    vectors = spark.createDataFrame(rows, "id long, v array<double>, label string")
    whole, few = (rank.similar_pairs(vectors, ["label"], 0.9, forest=f).collect() for f in (False, True))
    assert len(whole) > 10_000 and len(few) < 200

    def linked(pairs, cut):
        names = list(range(200))
        for r in pairs:
            if r["similarity"] >= cut and names[r["a"]] != names[r["b"]]:
                old, new = sorted((names[r["a"]], names[r["b"]]), reverse=True)
                names = [new if n == old else n for n in names]
        return names

    assert all(linked(whole, c) == linked(few, c) for c in (0.9, 0.999, 0.9999, 0.99999))
    assert len(set(linked(few, 0.99999))) > 1
