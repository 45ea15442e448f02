"""The standing audit over restarts, against the last state of each file."""

from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from sievework.plans.provenance import Run, read_events, read_manifests
from sievework.streaming import run_audit as ra

START = datetime(2024, 1, 1, tzinfo=UTC)


class Feed:
    """A folder of facts and a stream over it that is started anew for each batch."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root

    def take(self, *rows):
        facts = [(run, artifact, kind, sha, START + timedelta(minutes=m)) for run, artifact, kind, sha, m in rows]
        self.spark.createDataFrame(facts, ra.FACTS).coalesce(1).write.mode("append").parquet(str(self.root / "facts"))
        stream = self.spark.readStream.schema(ra.FACTS).parquet(str(self.root / "facts"))
        ra.run_audit(stream, str(self.root / "out"), str(self.root / "mark"), patience_seconds=3600, delay="0 seconds").awaitTermination()
        return {(r["run_id"], r["artifact"], r["reason"]) for r in ra.open_findings(self.told()).collect()}

    def told(self):
        return self.spark.read.schema(ra.CHANGES).parquet(str(self.root / "out"))


def test_findings_come_and_go_over_restarts(spark, tmp_path):
    feed, store = Feed(spark, tmp_path), spark.conf.get(ra._STORE[0], None)
    assert feed.take(("r", "", "opened", None, 0), ("r", "a", "written", "1", 1), ("r", "b", "written", "2", 1), ("q", "", "opened", None, 0), ("q", "", "sealed", None, 5)) == set()
    assert feed.take(("r", "a", "seen", None, 10), ("r", "b", "seen", "2", 10), ("r", "c", "seen", "9", 10)) == {("r", "a", ra.MISSING)}
    assert feed.take(("r", "a", "seen", "1", 20), ("r", "b", "seen", "x", 20)) == {("r", "b", ra.CHANGED)}
    assert feed.take(("r", "b", "seen", None, 30)) == {("r", "b", ra.MISSING)}
    assert feed.take(("r", "b", "written", "3", 40), ("r", "b", "seen", "3", 41)) == set()
    assert feed.take(("z", "", "opened", None, 90)) | feed.take(("z", "x", "written", "1", 91)) == {("r", "", ra.NEVER_SEALED)}
    assert feed.take(("r", "", "sealed", None, 95)) == set()
    assert feed.take(("later", "x", "written", "1", 400)) | feed.take(("later", "y", "written", "1", 401)) == {("z", "", ra.NEVER_SEALED)}
    counts = {r["change"]: r["count"] for r in feed.told().groupBy("change").count().collect()}
    assert counts == {"raised": 5, "retracted": 4} and spark.conf.get(ra._STORE[0], None) == store


def test_facts_of_runs(spark, tmp_path):
    run = Run.start(tmp_path / "runs", target_id="t", stage="filter", run_id="r1", repo_root=tmp_path)
    (run.folder / "artifacts" / "x").write_text("1")
    entry = run.register_artifact(run.folder / "artifacts" / "x")
    manifests, events = read_manifests(spark, str(tmp_path / "runs"), "t"), read_events(spark, str(tmp_path / "runs"), "t")
    facts = ra.facts_of(manifests, events).collect()
    assert {(r["run_id"], r["artifact"], r["kind"], r["sha256"]) for r in facts} == {("r1", "", "opened", None), ("r1", "artifacts/x", "written", entry["sha256"])} and all(r["at"] for r in facts)
    files = manifests.select("run_id", "run_dir", F.explode(F.array(F.lit("artifacts/x"), F.lit("artifacts/gone"))).alias("artifact"))
    assert {(r["artifact"], r["sha256"]) for r in ra.look(files).collect()} == {("artifacts/x", entry["sha256"]), ("artifacts/gone", None)}
    run.seal()
    sealed = ra.facts_of(read_manifests(spark, str(tmp_path / "runs"), "t"), events)
    assert {r["kind"] for r in sealed.collect()} == {"opened", "sealed", "written"}
