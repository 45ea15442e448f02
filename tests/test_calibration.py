import json
import math
import random

import pytest

from sievework.operators import calibration, contacts
from sievework.sources.adapters import collect_designs
from sievework.sources.registry import Registry


def test_derived_columns_and_separation(spark, tmp_path):
    rows = [("HKTDSFVGLM", "1", 50.0, 0.9), ("CAC", "1", None, 0.2), ("CFYFLM", "Difficult to make", 500.0, 0.7), (None, None, None, None), ("AAA", "0", 120.0, 0.1)]
    spark.createDataFrame(rows, "seq string, made string, ec50 double, score double").coalesce(1).write.csv(str(tmp_path / "t.csv"), header=True)
    df = calibration.derive(calibration.read_table(spark, str(tmp_path / "t.csv")), "seq", "made", "ec50")
    got = {r["seq"]: r for r in df.collect()}
    assert got["HKTDSFVGLM"]["hit"] and got["HKTDSFVGLM"]["natural_motif"] and got["HKTDSFVGLM"]["tested"] and got["CAC"]["n_cys"] == 2 and got["CAC"]["disulfide"]
    assert got["CFYFLM"]["hard_synth"] and not got["CFYFLM"]["hit"] and got[None]["len"] == 0 and not got[None]["active"]
    best = calibration.separation(df, ["score", "len"], "hit", "not hard_synth").collect()
    assert best[0]["score"] in ("score", "len") and best[0]["auc"] == 1.0 and best[0]["median_pos"] in (0.9, 10)
    row = calibration.combined(df, {"score": 0.5}, "hit").first()
    assert (row["n"], row["hits"], row["recall"]) == (2, 1, 1.0) and row["lift"] == pytest.approx(0.5 / 0.2)
    calibration.write_thresholds(tmp_path / "x.json", {"score": 0.5})
    assert json.loads((tmp_path / "x.json").read_text()) == {"score": 0.5}


def test_contacts_against_all_pairs(spark):
    rng = random.Random(2)
    atoms = lambda n: [(rng.choice("PQ"), i, *(rng.uniform(-9, 9) for _ in range(3))) for i in range(n)]
    a, b = atoms(80), atoms(80)
    schema = "structure string, atom long, x double, y double, z double"
    got = {(r["structure"], r["a"], r["b"]) for r in contacts.contacts(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)).collect()}
    want = {(p[0], p[1], q[1]) for p in a for q in b if p[0] == q[0] and math.dist(p[2:], q[2:]) <= 3.5}
    assert got == want and len(want) > 5


def test_designs_of_a_tool(spark, tmp_path):
    line = {"design_id": "a", "target_id": "t", "modality": "m", "pipeline": "p", "config_hash": "h", "sequence": "ACD", "length": 3, "metrics": {"iptm": 0.9}}
    (tmp_path / "x.jsonl").write_text(json.dumps(line) + "\n\n" + json.dumps(line | {"design_id": "b"}) + "\n")
    rows = collect_designs(spark, [str(tmp_path / "x.jsonl")])
    registry = Registry(spark, str(tmp_path / "r"))
    registry.upsert(rows)
    assert registry.get("b")["metrics"] == '{"iptm": 0.9}' and registry.read().count() == 2
