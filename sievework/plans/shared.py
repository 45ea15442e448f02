"""Intermediate results in the folder that driver and executors share.

Lineage is cut by writing Parquet under ``spark.checkpoint.dir``; a lost
executor then costs one re-read, never a recomputation of the upstream
plan.  In local mode without that setting a temporary folder is used.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate files, as a URI or path without trailing slash."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if sc.applicationId not in _LOCAL:
        made = _LOCAL[sc.applicationId] = tempfile.mkdtemp(prefix="sievework-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
    return _LOCAL[sc.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/sievework-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder through Hadoop's file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


_OWNERS = threading.local()


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete at its end what this thread materializes within; for work whose result is written elsewhere by then."""
    stack = _OWNERS.__dict__.setdefault("stack", [])
    stack.append([])
    try:
        yield
    finally:
        for path in stack.pop():
            remove(spark, path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back; later plans start from the files."""
    spark = df.sparkSession
    path = new_path(spark, label)
    if stack := getattr(_OWNERS, "stack", None):
        stack[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
