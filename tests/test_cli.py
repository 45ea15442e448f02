import pytest

from sievework.cli import main
from sievework.operators.rules import RULES
from sievework.plans.review import build_context, run_review
from sievework.sources.registry import Registry
from tests.cases import TARGET, make


def test_filter_validate_rank_and_generate(spark, tmp_path, monkeypatch, capsys):
    c = make(spark, tmp_path)
    monkeypatch.chdir(c.root)
    base = ["--target", str(c.target), "--db", c.registry.path]
    assert main(["validate", *base, "--predictors", "one,two"], spark) == 0
    assert main(["filter", *base, "--profile", str(c.profile)], spark) == 0
    assert main(["rank", *base, "--quota", "2"], spark) == 0
    rows = Registry(spark, c.registry.path).query_target(TARGET).collect()
    assert sum(r["selected"] for r in rows) == 2 and all(r["stage"] == "rank" and r["predictors_agreeing"] == 2 and r["final_score"] > 0 for r in rows)
    assert all(r["passed_screen"] and r["passed_select"] for r in rows)
    assert main(["generate", "--target", str(c.target), "--pipelines", "a,b", "--budget", "7"], spark) == 0
    assert "a: 4" in capsys.readouterr().out
    with pytest.raises(NotImplementedError):
        main(["prepare", "--target", str(c.target)], spark)
    assert main(["export", *base, "--out", str(tmp_path / "out"), "--profile", str(c.profile), "--runs-root", str(c.runs), "--allow-blocked"], spark) == 0


def test_stages_keep_what_they_do_not_set(spark, tmp_path, monkeypatch, capsys):
    c = make(spark, tmp_path)
    monkeypatch.chdir(c.root)
    registry = Registry(spark, c.registry.path)
    raw = '{"sc":"0.7","i_pTM":0.9,"pLDDT":90.0,"i_PAE":0.2,"note":"x"}'
    rows = [r.asDict() for r in registry.query_target(TARGET).collect()]
    odd, fallen = rows[0]["design_id"], rows[1]["design_id"]
    registry.upsert_many([rows[0] | {"metrics": raw}, rows[1] | {"metrics": {"i_pTM": 0.1}, "selected": True}])
    base = ["--target", str(c.target), "--db", c.registry.path]
    for command in (["validate", *base, "--predictors", "one,two"], ["filter", *base, "--profile", str(c.profile)], ["rank", *base, "--quota", "3"]):
        assert main(command, spark) == 0
    after = {r["design_id"]: r for r in registry.query_target(TARGET).collect()}
    assert after[odd]["metrics"] == raw and after[odd]["selected"] and after[odd]["run_id"] == rows[0]["run_id"]
    assert after[fallen]["selected"] is False and after[fallen]["passed_select"] is False and after[fallen]["stage"] == "filter"
    assert "no buried_sasa_norm" in capsys.readouterr().err
    told = run_review(build_context(spark, registry, TARGET, target_path=c.target, profile_path=c.profile, repo_root=c.root), rules=[r for r in RULES if r[0] == "R8"]).to_dict()["findings"]
    assert [(r["design_id"], r["artifact"]) for r in told if r["severity"] == "BLOCK"] == [(odd, "sc")]


def test_rank_numbers_clusters_and_gates_hold_back(spark, tmp_path, monkeypatch):
    c = make(spark, tmp_path)
    monkeypatch.chdir(c.root)
    profile = tmp_path / "gates.yaml"
    low, high = sorted(len(r["sequence"]) for r in c.rows)[:2]
    profile.write_text(c.profile.read_text() + f"peptide_specific: {{length: [{high}, 40], length_sweet_spot: [1, {high}]}}\n")
    ids = sorted(r["design_id"] for r in c.rows)
    spark.createDataFrame([(a, b, 0.1) for a in ids for b in ids if a < b], "a string, b string, similarity double").write.parquet(str(tmp_path / "pairs"))
    base = ["--target", str(c.target), "--db", c.registry.path]
    assert main(["filter", *base, "--profile", str(profile)], spark) == 0 and main(["rank", *base, "--quota", "9", "--pairs", str(tmp_path / "pairs")], spark) == 0
    rows = {r["design_id"]: r for r in Registry(spark, c.registry.path).query_target(TARGET).collect()}
    short = {r["design_id"] for r in c.rows if len(r["sequence"]) < high}
    assert short and all(("gate:length" in (r["liability_flags"] or "")) == (d in short) and r["passed_select"] for d, r in rows.items())
    kept = sorted(d for d, r in rows.items() if r["selected"])
    assert set(kept) == set(rows) - short and [rows[d]["cluster_id"] for d in kept] == list(range(1, len(kept) + 1))
