"""The candidate registry: Parquet batches that are only ever added, latest row wins.

A write adds one folder ``batch=<number>-<suffix>``, partitioned by target,
and touches no other.  The number is one more than the greatest there; the
random suffix keeps writers apart that see the same batches, so none can
overwrite another's.  Every row carries the batch it came with (``_at``) and
its place in it (``_seq``); a read is one scan of the finished batches and
keeps, per design, the row that is last by these, and the first
``created_at``.  Columns that an old batch lacks read null.  ``compact``
copies the rows that are last, with their ``_at``, into a new batch and
removes the batches it read; what others add meanwhile stays, and stays
newer or older as it was.  A read that began before a compaction ended may
miss its files and must be made again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework import schema
from sievework.plans.shared import materialize, temporary

_BATCH = "batch="
#: Rows that a task of a write sorts by target.
ROWS = 500_000
_PLACE = [T.StructField("_at", T.StringType()), T.StructField("_seq", T.LongType())]


class Registry:
    """Designs under ``path``; any file system that Spark reads will do."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(self.path))

    def batches(self) -> list[str]:
        """Names of the finished batches, in the order of their numbers."""
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.path))]
        return sorted(n[len(_BATCH) :] for n in names if n.startswith(_BATCH) and self._fs.exists(self._path(f"{self.path}/{n}/_SUCCESS")))

    def _rows(self, batches: list[str]) -> DataFrame:
        """All rows of some batches with ``_at`` and ``_seq``, by one scan; columns that a batch lacks read null."""
        stored = T.StructType([*schema.DESIGNS, *_PLACE])
        if not batches:
            return self.spark.createDataFrame([], stored)
        found = self.spark.read.schema(stored).option("basePath", self.path).parquet(*[f"{self.path}/{_BATCH}{n}" for n in batches])
        return found.select(*stored.names)

    def _last(self, rows: DataFrame, only: Column | None = None) -> DataFrame:
        """The last row of every design with its place, if ``only`` holds for it.

        The winners are chosen on narrow rows; of the wide ones only those
        that may be wanted are joined to them.
        """
        winners = rows.groupBy(F.col("design_id").alias("_id")).agg(F.max(F.struct("_at", "_seq")).alias("_won"), F.min("created_at").alias("_created"))
        wanted = rows if only is None else rows.where(only)
        same = (wanted["design_id"] == F.col("_id")) & (wanted["_at"] == F.col("_won._at")) & (wanted["_seq"] == F.col("_won._seq"))
        # Files of well compressed rows look small enough to be broadcast; sorted runs can spill.
        return wanted.join(winners.hint("merge"), same).withColumn("created_at", F.col("_created")).select(*schema.DESIGNS.names, "_at", "_seq")

    def _latest(self, only: Column | None = None) -> DataFrame:
        return self._last(self._rows(self.batches()), only).drop("_at", "_seq")

    def read(self) -> DataFrame:
        """All designs, one row each."""
        return self._latest()

    def query_target(self, target_id: str, stage: str = "all") -> DataFrame:
        """Designs of a target, of whose partitions alone wide rows are read; a named stage matches exactly, so a null stage matches none."""
        only = F.col("target_id") == target_id
        return self._latest(only if stage == "all" else only & (F.col("stage") == stage))

    def get(self, design_id: str) -> dict | None:
        """One design as a dict, or None; the filter reaches the Parquet scan."""
        rows = self._last(self._rows(self.batches()).where(F.col("design_id") == design_id)).drop("_at", "_seq").take(1)
        return rows[0].asDict() if rows else None

    def _write(self, rows: DataFrame, number: int) -> str:
        """Add a batch of rows with ``_seq``, which are written already somewhere; rows without ``_at`` came with this one."""
        name = f"{number:09d}-{uuid.uuid4().hex[:12]}"
        placed = rows if "_at" in rows.columns else rows.withColumn("_at", F.lit(name))
        parts = max(1, -(-placed.count() // ROWS))  # told: rows compress so well that tasks cut by bytes would hold millions
        placed.repartitionByRange(parts, "target_id", "design_id").write.partitionBy("target_id").parquet(f"{self.path}/{_BATCH}{name}")
        return name

    def upsert(self, rows: DataFrame) -> None:
        """Insert or overwrite all columns but the key and ``created_at``, with null where the input has none.

        Rows that repeat an id must say which is last by a column ``_seq``,
        different for each; else they are refused.  A row without an id gets
        one of 12 hexadecimal digits, drawn once.  The input's plan runs
        once; its result is checked on narrow columns before it is added.
        """
        named = F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 1, 12)
        rows = rows.withColumn("design_id", F.coalesce("design_id", named) if "design_id" in rows.columns else named)
        missing = [c for c in schema.NOT_NULL if c not in rows.columns]
        if missing:
            raise ValueError(f"columns without a value: {', '.join(missing)}")
        types = {f.name: f.dataType for f in schema.DESIGNS}
        columns = [F.col(c).cast(types[c]).alias(c) if c in rows.columns else F.lit(schema.DEFAULTS.get(c)).cast(types[c]).alias(c) for c in schema.COLUMNS]
        seq = F.col("_seq").cast("long") if "_seq" in rows.columns else F.lit(0).cast("long")
        with temporary(self.spark):
            ready = materialize(rows.select(*columns, F.current_timestamp().alias("created_at"), seq.alias("_seq")), "upsert")
            bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in schema.NOT_NULL], F.col("target_id") == "")
            if not ready.where(bad).isEmpty():
                raise ValueError(f"null in one of: {', '.join(schema.NOT_NULL)}; or an empty target_id")
            if not ready.groupBy("design_id", "_seq").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
                raise ValueError("a design_id is repeated and nothing says which row is last")
            numbers = [int(n.split("-")[0]) for n in self.batches()]
            self._write(ready, max(numbers, default=0) + 1)

    def update(self, changes: DataFrame) -> None:
        """Set the given columns of registered designs, by ``design_id``; all other columns stay as they are stored."""
        names = [c for c in changes.columns if c != "design_id"]
        new = changes.select("design_id", *[F.col(c).alias(f"_new_{c}") for c in names])
        rows = self.read().join(new, "design_id")
        self.upsert(rows.withColumns({c: F.col(f"_new_{c}") for c in names}).drop("created_at", *[f"_new_{c}" for c in names]))

    def upsert_many(self, records: Iterable[dict]) -> int:
        """Upsert dicts; of repeated ids the last wins.  Returns the number of records."""
        types = {f.name: f.dataType for f in schema.DESIGNS}
        rows = []
        for seq, record in enumerate(records):
            row = {c: schema.DEFAULTS.get(c) for c in schema.COLUMNS} | {k: v for k, v in record.items() if k in types and k != "created_at"}
            for c in (*schema.JSON_OBJECTS, *schema.JSON_ARRAYS):
                if row[c] is not None and not isinstance(row[c], str):
                    row[c] = json.dumps(row[c])
            rows.append((*[row[c] for c in schema.COLUMNS], seq))
        if rows:
            fields = [T.StructField(c, types[c]) for c in schema.COLUMNS] + [T.StructField("_seq", T.LongType())]
            self.upsert(self.spark.createDataFrame(rows, T.StructType(fields)))
        return len(rows)

    def compact(self) -> None:
        """Replace the batches that are there by one with the rows that are last."""
        read = self.batches()
        if len(read) > 1:
            with temporary(self.spark):
                self._write(materialize(self._last(self._rows(read)), "compact"), int(read[-1].split("-")[0]))
            for n in read:
                self._fs.delete(self._path(f"{self.path}/{_BATCH}{n}"), True)


def _number(value: Column) -> Column:
    """A JSON value as a double: numbers and booleans; null for strings and others."""
    kind = F.schema_of_variant(value)
    return F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("double")).when(
        kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.try_variant_get(value, "$", "double")
    )


def decode(designs: DataFrame) -> DataFrame:
    """Registry rows for use: NaN as null, JSON text as maps and arrays, empty where null or malformed.

    ``metrics`` holds the numeric metrics and ``metric_names`` all names.
    """
    raw = F.from_json("metrics", "map<string,variant>")
    numeric = F.map_filter(F.transform_values(raw, lambda k, v: _number(v)), lambda k, v: v.isNotNull())
    out = designs.withColumns(
        {
            "final_score": F.nanvl("final_score", F.lit(None).cast("double")),
            "metric_names": F.coalesce(F.map_keys(raw), F.array().cast("array<string>")),
            "metrics": F.coalesce(numeric, F.create_map().cast("map<string,double>")),
            "liability_flags": F.coalesce(F.from_json("liability_flags", "array<string>"), F.array().cast("array<string>")),
        }
    )
    for c in ("artifact_hashes", "predictor_outputs"):
        out = out.withColumn(c, F.coalesce(F.from_json(c, "map<string,string>"), F.create_map().cast("map<string,string>")))
    return out
