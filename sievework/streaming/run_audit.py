"""A standing audit of runs: findings that are raised and retracted as events arrive.

Facts are rows (run_id, artifact, kind, sha256, at):

opened, sealed  of a run, with an empty artifact
written         a file was registered with its hash
seen            a file was looked at; no hash means that it isn't there

State is kept by run and artifact, so a run with very many files is no hot
key.  A file that isn't there, or has another hash than registered, raises a
finding; when it comes back, or is registered anew, the finding is
retracted.  A run that isn't sealed within ``patience`` of its opening, told
by the facts' own time, raises one by a timer, and its sealing retracts it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from sievework.sources.files import probe

FACTS = "run_id string, artifact string, kind string, sha256 string, at timestamp"
CHANGES = "run_id string, artifact string, change string, reason string, at timestamp"
NEVER_SEALED, MISSING, CHANGED = "never_sealed", "missing", "hash_mismatch"
_STORE = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class RunAudit(StatefulProcessor):
    """Changes of findings of one artifact of a run, or of the run itself."""

    def __init__(self, patience_ms: int):
        self.patience_ms = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "expected string, looked boolean, seen string, sealed boolean, reason string")

    def _known(self) -> dict:
        names = ("expected", "looked", "seen", "sealed", "reason")
        return dict(zip(names, self.state.get(), strict=True)) if self.state.exists() else dict.fromkeys(names)

    def _keep(self, now: dict) -> None:
        self.state.update(tuple(now[n] for n in ("expected", "looked", "seen", "sealed", "reason")))

    def _changed(self, key, now: dict, reason: str | None, at) -> list[tuple]:
        """Rows that take back the finding before and tell the new one, if they differ."""
        before, now["reason"] = now["reason"], reason
        if before == reason:
            return []
        return [(*key, change, r, at) for change, r in (("retracted", before), ("raised", reason)) if r is not None]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, out = self._known(), []
        facts = pd.concat(list(rows)).sort_values(["at", "kind"], kind="stable")  # of one file, or of one run's opening and sealing
        for kind, sha256, at in zip(facts["kind"], facts["sha256"], facts["at"], strict=True):
            sha256 = sha256 if isinstance(sha256, str) else None
            if kind == "opened" and not now["sealed"]:
                self.handle.registerTimer(int(at.timestamp() * 1000) + self.patience_ms)
            elif kind == "sealed":
                now["sealed"] = True
                out += self._changed(key, now, None, at)
            elif kind == "written":
                now["expected"] = sha256
            elif kind == "seen":
                now["looked"], now["seen"] = True, sha256
            if kind in ("written", "seen") and now["expected"] is not None and now["looked"]:
                out += self._changed(key, now, MISSING if now["seen"] is None else CHANGED if now["seen"] != now["expected"] else None, at)
        self._keep(now)
        yield pd.DataFrame(out, columns=["run_id", "artifact", "change", "reason", "at"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, out = self._known(), []
        if not now["sealed"]:
            out = self._changed(key, now, NEVER_SEALED, pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms"))
            self._keep(now)
        yield pd.DataFrame(out, columns=["run_id", "artifact", "change", "reason", "at"])

    def close(self) -> None:
        return


def facts_of(manifests: DataFrame, events: DataFrame) -> DataFrame:
    """Facts of manifests (an opening, and a sealing if they have an end) and of event logs, as streams or tables."""
    at = lambda c: F.to_timestamp(c)
    fact = lambda kind, when, artifact="": F.struct(F.lit(artifact).alias("artifact") if isinstance(artifact, str) else artifact.alias("artifact"), F.lit(kind).alias("kind"), when.alias("at"))
    both = F.array(fact("opened", at("started_at")), F.when(F.col("ended_at").isNotNull(), fact("sealed", at("ended_at"))))
    runs = manifests.select("run_id", F.explode(F.array_compact(both)).alias("f")).select("run_id", "f.artifact", "f.kind", F.lit(None).cast("string").alias("sha256"), "f.at")
    written = events.where("action = 'artifact_written'").select("run_id", "artifact", F.lit("written").alias("kind"), "sha256", at("ts").alias("at"))
    return runs.union(written)


def look(files: DataFrame) -> DataFrame:
    """Facts of what files (run_id, run_dir, artifact) are now."""
    placed = files.select("run_id", "artifact", F.when(F.col("artifact").rlike("^/|://"), F.col("artifact")).otherwise(F.concat_ws("/", "run_dir", "artifact")).alias("path")).distinct()
    found = placed.join(probe(placed, [], hashed=True), "path", "left")
    return found.select("run_id", "artifact", F.lit("seen").alias("kind"), "sha256", F.current_timestamp().alias("at"))


@contextmanager
def _rocksdb(spark: SparkSession):
    """The state store that keyed state with timers needs, for queries that start within."""
    before = spark.conf.get(_STORE[0], None)
    spark.conf.set(*_STORE)
    try:
        yield
    finally:
        spark.conf.unset(_STORE[0]) if before is None else spark.conf.set(_STORE[0], before)


def changes(facts: DataFrame, patience_seconds: int = 7 * 86_400, delay: str = "10 minutes") -> DataFrame:
    """Changes of findings of a stream of facts; facts without a run or time take no part."""
    known = facts.where("run_id is not null and at is not null").withColumn("artifact", F.coalesce("artifact", F.lit(""))).withWatermark("at", delay)
    return known.groupBy("run_id", "artifact").transformWithStateInPandas(RunAudit(patience_seconds * 1000), CHANGES, "Append", "EventTime")


def run_audit(facts: DataFrame, sink: str, checkpoint: str, patience_seconds: int = 7 * 86_400, delay: str = "10 minutes") -> StreamingQuery:
    """Append the changes of findings to a folder of Parquet files."""
    with _rocksdb(facts.sparkSession):
        return changes(facts, patience_seconds, delay).writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(sink)


def open_findings(told: DataFrame) -> DataFrame:
    """(run_id, artifact, reason, at) of what was raised and not retracted, from changes."""
    raised = F.count_if(F.col("change") == "raised") - F.count_if(F.col("change") == "retracted")
    counted = told.groupBy("run_id", "artifact", "reason").agg(raised.alias("n"), F.max(F.when(F.col("change") == "raised", F.col("at"))).alias("at"))
    return counted.where("n > 0").select("run_id", "artifact", "reason", "at")
