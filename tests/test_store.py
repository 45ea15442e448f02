import json
import threading
import time
from concurrent.futures import ThreadPoolExecutor

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sievework.plans import shared
from sievework.plans.provenance import Run, git_state, read_entries, read_events, read_manifests, read_runs, verify_artifacts, verify_entries
from sievework.sources.config import config_hash, config_hashes, load_profile, target_id
from sievework.sources.files import flatten_metrics, read_fasta
from sievework.sources.registry import Registry, decode

ROW = {"design_id": "a", "target_id": "t", "modality": "peptide", "pipeline": "p", "config_hash": "h", "sequence": "ACD", "length": 3}


def test_upsert_keeps_created_at_and_overwrites_with_null(spark, tmp_path):
    r = Registry(spark, str(tmp_path / "r"))
    assert r.read().count() == 0 and r.get("a") is None
    assert r.upsert_many([ROW | {"final_score": 1.0, "stage": "filter"}, ROW | {"design_id": "b"}, ROW | {"design_id": "b", "seed": 7}]) == 3
    before = r.get("a")
    time.sleep(1.1)
    r.upsert_many([ROW | {"sequence": "ACDE"}])
    after = r.get("a")
    assert after["created_at"] == before["created_at"] and after["sequence"] == "ACDE" and after["final_score"] is None
    assert r.get("b")["seed"] == 7 and r.get("b")["passed_screen"] is False
    assert r.query_target("t").count() == 2 and r.query_target("t", "filter").count() == 0
    r.compact()
    assert len(r.batches()) == 1 and r.get("a") == after
    with pytest.raises(ValueError):
        r.upsert(spark.createDataFrame([("x", None)], "design_id string, target_id string"))


def test_old_batches_read_null_in_added_columns(spark, tmp_path):
    r = Registry(spark, str(tmp_path / "r"))
    r.upsert_many([ROW])
    old = r.read().drop("run_id", "stage", "manifest_uri").withColumn("_seq", F.lit(0).cast("long")).withColumn("design_id", F.lit("old"))
    r._write(old, 5)
    assert r.get("old")["run_id"] is None and r.read().count() == 2


def test_two_writers_at_once_lose_nothing(spark, tmp_path, monkeypatch):
    """Both list the same batches before either writes."""
    r, barrier, plain = Registry(spark, str(tmp_path / "r")), threading.Barrier(2, timeout=120), Registry._write
    r.upsert_many([ROW | {"design_id": "old"}])

    def write(self, rows, number):
        barrier.wait()
        return plain(self, rows, number)

    monkeypatch.setattr(Registry, "_write", write)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda x: Registry(spark, r.path).upsert_many([ROW | {"design_id": x}, ROW | {"design_id": "both", "sequence": x}]), ["x1", "x2"]))
    rows = {x["design_id"]: x["sequence"] for x in r.read().collect()}
    assert rows.keys() == {"old", "x1", "x2", "both"} and rows["both"] in ("x1", "x2") and len(r.batches()) == 3


def test_a_write_during_a_compaction_stays_newer(spark, tmp_path, monkeypatch):
    """A writer lists batches, others write and compact, then it writes: its row is as new as its number says."""
    r, plain, done = Registry(spark, str(tmp_path / "r")), Registry._write, []
    r.upsert_many([ROW | {"sequence": "one"}])

    def write(self, rows, number):
        if not done:
            done.append(1)
            r.upsert_many([ROW | {"design_id": "b"}])
            r.compact()
            assert len(r.batches()) == 1
        return plain(self, rows, number)

    monkeypatch.setattr(Registry, "_write", write)
    r.upsert_many([ROW | {"sequence": "two"}])
    assert r.get("a")["sequence"] == "two" and r.get("b") and r.read().count() == 2
    r.compact()
    r.compact()
    assert len(r.batches()) == 1 and r.get("a")["sequence"] == "two"


def test_an_upsert_runs_its_input_once_and_moves_targets(spark, tmp_path):
    r, met = Registry(spark, str(tmp_path / "r")), spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame([tuple(ROW.values())] * 1, list(ROW))
    counted = F.udf(lambda x: met.add(1) or x)
    r.upsert(rows.withColumn("design_id", counted("design_id")))
    assert met.value == 1
    r.upsert_many([ROW | {"target_id": "other one/2"}])
    assert r.query_target("t").isEmpty() and r.query_target("other one/2").first()["design_id"] == "a"
    with pytest.raises(ValueError):
        r.upsert_many([ROW | {"target_id": ""}])
    with pytest.raises(ValueError):
        r.upsert(spark.createDataFrame([tuple(ROW.values())] * 2, list(ROW)))
    assert len(r.batches()) == 2
    plan = r.query_target("t")._jdf.queryExecution().executedPlan().toString()
    assert "target_id#" in plan and "PartitionFilters: [isnotnull(target_id" in plan


def test_intermediate_results_go_with_their_owner(spark):
    with shared.temporary(spark):
        inner = shared.materialize(spark.range(3), "kept")
        place = Path(inner.inputFiles()[0].removeprefix("file://")).parent
        with shared.temporary(spark):
            gone = Path(shared.materialize(spark.range(3), "gone").inputFiles()[0].removeprefix("file://")).parent
        assert place.exists() and not gone.exists() and inner.count() == 3
    assert not place.exists()
    assert shared.materialize(spark.range(3), "free").count() == 3


def test_decode_json_columns(spark, tmp_path):
    r = Registry(spark, str(tmp_path / "r"))
    r.upsert_many([ROW | {"metrics": '{"iPTM": 0.9, "s": "0.5", "b": true, "n": null}', "final_score": float("nan")}, ROW | {"design_id": "b", "metrics": "{broken"}])
    rows = {x["design_id"]: x for x in decode(r.read()).collect()}
    assert rows["a"]["metrics"] == {"iPTM": 0.9, "b": 1.0} and set(rows["a"]["metric_names"]) == {"iPTM", "s", "b", "n"} and rows["a"]["final_score"] is None
    assert rows["b"]["metrics"] == {} and rows["b"]["liability_flags"] == [] and rows["b"]["artifact_hashes"] == {}


def test_runs(spark, tmp_path):
    source = tmp_path / "in.txt"
    source.write_text("x")
    run = Run.start(tmp_path / "runs", target_id="t", stage="generate", code_rev="r", code_dirty=False, repo_root=tmp_path)
    assert run.manifest["run_id"].startswith("gen-") and run.manifest["run_id"].endswith("-r")
    with pytest.raises(FileExistsError):
        Run.start(tmp_path / "runs", target_id="t", stage="generate", run_id=run.manifest["run_id"])
    run.snapshot_input(source)
    art = run.folder / "artifacts" / "a.txt"
    art.write_text("one")
    entry = run.register_artifact(art, design_id="d", metrics={"m": 1})
    run.write_env_lock()
    with pytest.raises(FileNotFoundError):
        run.register_artifact(run.folder / "none")
    assert [e["action"] for e in run.events()] == ["input_snapshot", "artifact_written", "artifact_written"]
    manifests = read_manifests(spark, str(tmp_path / "runs"), "t")
    assert verify_artifacts(manifests).count() == 0
    art.write_text("two")
    (run.folder / "env.lock.txt").unlink()
    broken = {r["path"]: r for r in verify_artifacts(manifests).collect()}
    assert broken[entry["path"]]["reason"] == "hash_mismatch" and broken["env.lock.txt"]["reason"] == "missing"
    run.seal()
    assert Run.open(run.folder).sealed
    with pytest.raises(RuntimeError):
        run.register_artifact(art)
    assert read_events(spark, str(tmp_path / "runs"), "t").count() == 3 and read_events(spark, str(tmp_path / "runs"), "none").count() == 0
    assert git_state(tmp_path / "nowhere") == (None, True)


def test_files_registered_by_executors(spark, tmp_path):
    run = Run.start(tmp_path / "runs", target_id="t", stage="validate", run_id="r", repo_root=tmp_path)
    for i in range(5):
        (run.folder / "artifacts" / f"{i}.txt").write_text(str(i))
    rows = [(str(run.folder / "artifacts" / f"{i}.txt"), f"d{i}") for i in range(5)]
    run.register_files(spark.createDataFrame(rows, "path string, design_id string"))
    run.register_artifact(run.folder / "artifacts" / "0.txt", design_id="again")
    assert len(run.events()) == 6 and {e["path"] for e in run.manifest["artifacts"]} == {f"artifacts/{i}.txt" for i in range(5)}
    manifests = read_manifests(spark, str(tmp_path / "runs"), "t")
    assert len(manifests.first()["artifacts"]) == 6 and verify_artifacts(manifests).count() == 0
    (run.folder / "artifacts" / "3.txt").write_text("x")
    assert [r["path"] for r in verify_artifacts(manifests).collect()] == ["artifacts/3.txt"]
    with pytest.raises(Exception, match="no such artifact"):
        run.register_files(spark.createDataFrame([("/nowhere",)], "path string"))
    entries = read_entries(spark, str(tmp_path / "runs"), "t")
    assert entries.count() == 6 and [tuple(r) for r in verify_entries(entries).collect()] == [tuple(r) for r in verify_artifacts(manifests).collect()]
    other = tmp_path / "runs" / "t" / "by-hand"
    other.mkdir()
    (other / "manifest.json").write_text(json.dumps({"run_id": "h", "artifacts": [{"path": "gone", "sha256": "0"}, {"path": "gone", "sha256": "1"}]}))
    assert {(r["run_id"], r["path"], r["expected"]) for r in verify_entries(read_entries(spark, str(tmp_path / "runs"), "t")).where("run_id = 'h'").collect()} == {("h", "gone", "1")}
    (other / "manifest.json").unlink()
    assert read_runs(spark, str(tmp_path / "runs"), "t").first()["artifacts"] is None
    run.seal()
    assert read_entries(spark, str(tmp_path / "runs"), "t").count() == 6
    assert len(read_manifests(spark, str(tmp_path / "runs"), "t").first()["artifacts"]) == 6 and Run.open(run.folder).opened["ended_at"]


def test_configurations(tmp_path):
    (tmp_path / "base.yaml").write_text("folding_confidence:\n  i_pTM: {screen: 0.5, select: 0.8}\n  keep: {screen: 1}\n")
    (tmp_path / "sub.yaml").write_text("# note\nextends: base.yaml\nfolding_confidence_override:\n  i_pTM: {screen: 0.6}\n")
    (tmp_path / "same.yaml").write_text("folding_confidence_override: {i_pTM: {screen: 0.6}}\nextends: base.yaml\n")
    (tmp_path / "bad.yaml").write_text("a: [")
    assert load_profile(tmp_path / "sub.yaml")["folding_confidence"] == {"i_pTM": {"screen": 0.6, "select": 0.8}, "keep": {"screen": 1}}
    assert "extends" in load_profile(tmp_path / "sub.yaml", strict=True)
    assert config_hash(tmp_path / "sub.yaml") == config_hash(tmp_path / "same.yaml")
    found = config_hashes(tmp_path)
    assert len(found) == 2 and found[config_hash(tmp_path / "sub.yaml")].endswith("sub.yaml")
    assert target_id(tmp_path / "base.yaml") == "base" and config_hashes(tmp_path / "no") == {}


def test_nested_metrics_take_the_first_by_level():
    data = json.loads('{"deep": {"iptm": 0.1}, "list": [{"plddt": 1}, [{"rmsd": 2}], {"pLDDT": 3}], "ipTM": 0.7, "i-pae": "0.2", "ptm": true}')
    assert flatten_metrics(data) == {"iptm": 0.7, "ptm": 1.0, "plddt": 1.0}
    assert flatten_metrics([1, {"iptm": 1}]) == {}


def test_fasta(spark, tmp_path):
    path = tmp_path / "x.fasta"
    path.write_text("stray\n>a|1\nAC\n DE \n\n>b\n>c>d\nFG\n")
    rows = {(r["header"], r["sequence"]) for r in read_fasta(spark, [str(path)]).collect()}
    assert rows == {(None, "stray"), ("a|1", "ACDE"), ("c>d", "FG")}


def test_a_write_s_tasks_hold_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    """One target's rows, which compress to almost nothing, go to several tasks, here by upsert and by compaction."""
    monkeypatch.setattr("sievework.sources.registry.ROWS", 300)
    registry = Registry(spark, str(tmp_path / "r"))
    blank = {c: F.lit("x") for c in ("target_id", "modality", "pipeline", "config_hash", "sequence")} | {"length": F.lit(1)}
    for start in (0, 1000):
        registry.upsert(spark.range(start, start + 1500).select(F.col("id").cast("string").alias("design_id")).withColumns(blank))
        assert all(len(list(b.glob("target_id=x/*.parquet"))) >= 4 for b in (tmp_path / "r").glob("batch=*"))
    registry.compact()
    assert len(registry.batches()) == 1 and len(list((tmp_path / "r").glob("batch=*/target_id=x/*.parquet"))) >= 7
    assert registry.read().count() == 2500
