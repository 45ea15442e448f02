import json
from collections import Counter

import pytest

from sievework.cli import main
from sievework.operators.rules import BLOCK, INFO, RULES, WARN
from sievework.plans import review
from sievework.plans import export as plan
from sievework.plans.export import ExportBlocked, export
from sievework.plans.review import build_context, run_review
from tests.cases import DEFECTS, OVERALL, TARGET, make


def context(spark, c, **more):
    more = {"package": c.package, "scope": "export"} | more
    return build_context(spark, c.registry, TARGET, target_path=c.target, profile_path=c.profile, runs_root=c.runs, configs_dir=c.configs, repo_root=c.root, **more)


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    return make(spark, tmp_path_factory.mktemp("clean"))


@pytest.fixture(scope="module")
def corrupt(spark, tmp_path_factory):
    return make(spark, tmp_path_factory.mktemp("corrupt"), corrupt=True)


@pytest.fixture(scope="module")
def corrupt_report(spark, corrupt):
    return run_review(context(spark, corrupt))


def test_clean_case_has_no_block_and_no_warning(spark, clean):
    report = run_review(context(spark, clean))
    assert report.counts[BLOCK] == report.counts[WARN] == 0, report.to_dict()["findings"]
    assert report.rules_run == [r[0] for r in RULES]
    assert report.exit_code() == report.exit_code("warn") == 0


def test_every_defect_has_its_findings_and_no_other(corrupt_report):
    names = {d[0] for d in DEFECTS}
    found, overall = {}, Counter()
    for r in corrupt_report.to_dict()["findings"]:
        told = f"{r['rule_id']} {r['severity']}"
        if r.get("design_id") in names:
            found.setdefault(r["design_id"], []).append(told)
        elif r["severity"] != INFO:
            overall[told] += 1
    assert {k: sorted(v) for k, v in found.items()} == {name: sorted(wanted) for name, _, wanted in DEFECTS}
    assert overall == OVERALL
    assert {x.split()[0] for _, _, wanted in DEFECTS for x in wanted} | {x.split()[0] for x in OVERALL} == {r[0] for r in RULES}


def test_order_codes_and_rendering(corrupt_report):
    rows = corrupt_report.to_dict()["findings"]
    rank = {BLOCK: 0, WARN: 1, INFO: 2}
    assert [(rank[r["severity"]], r["rule_id"], r.get("design_id") or "") for r in rows] == sorted((rank[r["severity"]], r["rule_id"], r.get("design_id") or "") for r in rows)
    assert corrupt_report.exit_code() == 1 and corrupt_report.exit_code("none") == 0 and corrupt_report.worst() == BLOCK
    text = corrupt_report.render()
    assert "blocked" in text and "claims-length" in text and "expected: `" in text


def test_scope_and_failing_rules(spark, clean):
    def broken(ctx):
        raise ValueError("no luck")

    report = run_review(context(spark, clean, package=None, scope="all"), rules=[("R0", "broken", broken, False), *RULES])
    assert "R12" not in report.rules_run
    rows = report.to_dict()["findings"]
    assert any(r["rule_id"] == "R0" and r["severity"] == INFO and "no luck" in r["message"] for r in rows)


def test_missing_data_is_told(spark, clean):
    ctx = context(spark, clean, package=None, scope="all")
    ctx.profile, ctx.hashes, ctx.runs = {}, {}, ctx.runs.limit(0)
    ctx.designs = ctx.designs.withColumn("selected", ctx.designs["selected"] & False)
    told = {r["rule_id"] for r in run_review(ctx).to_dict()["findings"] if r["severity"] == INFO}
    assert {"R1", "R6", "R7", "R10", "R11", "R13"} <= told
    ctx.designs = ctx.designs.limit(0)
    assert [r["rule_id"] for r in run_review(ctx).to_dict()["findings"]] == ["-"]


def test_semantic_findings_are_notes_only(spark, clean):
    ctx = context(spark, clean, package=None, scope="all")
    report = run_review(ctx, lambda summary: [{"rule_id": "R-SEM", "severity": BLOCK, "message": str(summary["n_records"])}], rules=[])
    assert [(r["severity"], r["message"]) for r in report.to_dict()["findings"]] == [(INFO, "4")]
    failing = run_review(ctx, lambda summary: 1 / 0, rules=[])
    assert failing.counts == {BLOCK: 0, WARN: 0, INFO: 1}


def test_export_gate(spark, clean, corrupt, tmp_path):
    more = lambda c: {"target_path": c.target, "profile_path": c.profile, "runs_root": c.runs, "repo_root": c.root}
    done = export(spark, clean.registry, TARGET, tmp_path / "good", **more(clean))
    assert not done["blocked"] and done["n_selected"] == 3 and (tmp_path / "good" / ".VERIFIED").exists()
    assert len(list((tmp_path / "good" / "structures").iterdir())) == 3
    assert "score=0.250" in (tmp_path / "good" / "submission.fasta").read_text()
    assert "diffusion`: 3" in (tmp_path / "good" / "METHODS.md").read_text()
    with pytest.raises(ExportBlocked):
        export(spark, corrupt.registry, TARGET, tmp_path / "bad", **more(corrupt))
    assert (tmp_path / "bad" / ".UNVERIFIED").exists() and not (tmp_path / "bad" / ".VERIFIED").exists()
    with pytest.raises(ExportBlocked, match="stays"):  # the verified package isn't replaced
        export(spark, corrupt.registry, TARGET, tmp_path / "good", **more(corrupt))
    assert (tmp_path / "good" / ".VERIFIED").exists() and (tmp_path / "good.staged" / ".UNVERIFIED").exists()
    again = export(spark, clean.registry, TARGET, tmp_path / "good", **more(clean))
    assert again["n_selected"] == 3 and not (tmp_path / "good.staged").exists() and len(list((tmp_path / "good" / "structures").iterdir())) == 3
    assert json.loads((tmp_path / "bad" / "review_findings.json").read_text())["counts"][BLOCK] > 0


def test_records_in_many_files(spark, clean, tmp_path, monkeypatch):
    monkeypatch.setattr(plan, "RECORDS", 2)
    designs = context(spark, clean, package=None, scope="all").designs
    (tmp_path / "many").mkdir()
    files = plan.write_fasta(designs, str(tmp_path / "many")).collect()
    assert sum(r["records"] for r in files) == 4 and len(files) == 2
    assert "".join(p.read_text() for p in sorted((tmp_path / "many").iterdir())).count(">sound-") == 4


def test_review_command(spark, corrupt, tmp_path, monkeypatch):
    monkeypatch.chdir(corrupt.root)
    args = ["review", "--target", str(corrupt.target), "--profile", str(corrupt.profile), "--db", corrupt.registry.path, "--runs-root", str(corrupt.runs), "--out", str(tmp_path)]
    assert main(args, spark) == 1
    assert main([*args, "--fail-on", "none"], spark) == 0
    assert (tmp_path / "review_report.md").exists()


def test_a_long_report_tells_what_it_leaves_out(corrupt_report, tmp_path, monkeypatch):
    monkeypatch.setattr(review, "HEAD", 5)
    assert len(corrupt_report.to_dict(5)["findings"]) == 5 and corrupt_report.to_dict(5)["left_out"] == corrupt_report.total - 5
    assert f"{corrupt_report.total - 5} more findings" in corrupt_report.render(most=5)
    corrupt_report.write(tmp_path)
    lines = [json.loads(x) for p in sorted((tmp_path / "findings").glob("part-*")) for x in p.read_text().splitlines()]
    assert len(lines) == corrupt_report.total and lines == corrupt_report.to_dict(10**6)["findings"]
