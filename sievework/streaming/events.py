"""Event logs and registry writes as streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sievework import schema
from sievework.plans.provenance import verify_artifacts
from sievework.plans.shared import new_path
from sievework.sources.registry import Registry


def tail_events(spark: SparkSession, runs_root: str, target_id: str, per_trigger: int | None = None) -> DataFrame:
    """Events of all runs of a target, as log files grow in number; ``ts`` is also read as time ``at``."""
    reader = spark.readStream.schema(schema.EVENTS)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.json(f"{runs_root.rstrip('/')}/{target_id}/*/provenance*.jsonl").withColumn("at", F.to_timestamp("ts"))


def once_per_artifact(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Each registration once, within the watermark."""
    return events.withWatermark("at", delay).dropDuplicatesWithinWatermark(["run_id", "artifact", "sha256"])


def window_counts(events: DataFrame, time_col: str = "ts", width: str = "1 hour", delay: str = "2 hours", keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """(start, keys, n, total) by window; batch and stream alike.  An extension of ours."""
    timed = events.withColumn("_at", F.col(time_col).cast("timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark("_at", delay)
    counted = timed.groupBy(F.window("_at", width), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("window.start").alias("start"), *keys, "n", "total")


def _run(stream: DataFrame, each: Callable[[DataFrame, int], None], label: str, checkpoint: str | None) -> StreamingQuery:
    place = checkpoint or new_path(stream.sparkSession, label)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", place).trigger(availableNow=True).start()


def upsert_stream(stream: DataFrame, registry: Registry, checkpoint: str | None = None) -> StreamingQuery:
    """Upsert every micro-batch; a batch that is replayed writes the same rows again, which changes nothing."""
    return _run(stream, lambda rows, _: registry.upsert(rows) if not rows.isEmpty() else None, "upsert-stream", checkpoint)


def audit_stream(manifests: DataFrame, sink: str, checkpoint: str | None = None) -> StreamingQuery:
    """Verify the artifacts of every manifest that arrives (columns of a manifest and run_dir) and append what is broken to ``sink``."""

    def each(rows: DataFrame, number: int) -> None:
        verify_artifacts(rows).withColumn("batch", F.lit(number)).write.mode("append").parquet(sink)

    return _run(manifests, each, "audit-stream", checkpoint)
