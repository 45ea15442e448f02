from pyspark.sql import functions as F

from sievework.plans.provenance import Run, read_events, read_manifests
from sievework.sources.registry import Registry
from sievework.streaming import events


def test_window_counts_of_stream_and_batch_are_equal(spark, tmp_path):
    rows = [(f"2024-01-01 0{h}:{m:02d}:00", k, float(m)) for h in range(4) for m in range(0, 60, 7) for k in ("a", "b")]
    df = spark.createDataFrame(rows, "ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.repartition(4).write.parquet(str(tmp_path / "e"))
    stream = events.window_counts(spark.readStream.schema(df.schema).parquet(str(tmp_path / "e")))
    q = stream.writeStream.format("memory").queryName("wc").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda d: sorted(map(tuple, d.collect()))
    assert key(spark.table("wc")) == key(events.window_counts(df))


def test_event_log_stream_and_audit(spark, tmp_path):
    run = Run.start(tmp_path / "runs", target_id="t", stage="filter", run_id="r1", repo_root=tmp_path)
    path = run.folder / "artifacts" / "x"
    path.write_text("1")
    for _ in range(2):
        run.register_artifact(path)
    tail = events.once_per_artifact(events.tail_events(spark, str(tmp_path / "runs"), "t"))
    q = tail.writeStream.format("memory").queryName("tail").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("tail").count() == 1 and read_events(spark, str(tmp_path / "runs"), "t").count() == 2
    path.write_text("2")
    read_manifests(spark, str(tmp_path / "runs"), "t").write.parquet(str(tmp_path / "m"))
    manifests = spark.readStream.schema(spark.read.parquet(str(tmp_path / "m")).schema).parquet(str(tmp_path / "m"))
    events.audit_stream(manifests, str(tmp_path / "broken"), str(tmp_path / "c2")).awaitTermination()
    assert [r["reason"] for r in spark.read.parquet(str(tmp_path / "broken")).collect()] == ["hash_mismatch"]


def test_upsert_stream_is_idempotent(spark, tmp_path):
    base = {"design_id": "a", "target_id": "t", "modality": "m", "pipeline": "p", "config_hash": "h", "sequence": "ACD", "length": 3}
    spark.createDataFrame([base, base | {"design_id": "b"}]).write.json(str(tmp_path / "in"))
    schema = "design_id string, target_id string, modality string, pipeline string, config_hash string, sequence string, length int"
    registry = Registry(spark, str(tmp_path / "r"))
    for turn in range(2):
        events.upsert_stream(spark.readStream.schema(schema).json(str(tmp_path / "in")), registry, str(tmp_path / f"c{turn}")).awaitTermination()
    assert registry.read().count() == 2
