"""Designs from external tools, as a Spark data source.

A tool writes JSON lines; an adapter names the files and maps a line to
registry columns.  ``spark.dataSource.register(DesignSource)`` makes
``spark.read.format("designs").option("path", ...).option("adapter", ...)``
work; ``collect_designs`` does the same without the registration.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator
from pathlib import Path
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sievework import schema
from sievework.sources.files import read_text

_TYPES = {f.name: f.dataType for f in schema.DESIGNS}
COLUMNS = T.StructType([T.StructField(c, _TYPES[c]) for c in schema.COLUMNS])


class Adapter(Protocol):
    """What a tool's adapter does."""

    def prepare(self, folder: Path) -> Path: ...

    def run(self, n: int) -> None: ...

    def record(self, line: dict) -> dict: ...


class JsonLines:
    """The plain adapter: a line has the registry's own names; nested values become JSON text."""

    def prepare(self, folder: Path) -> Path:
        folder.mkdir(parents=True, exist_ok=True)
        return folder

    def run(self, n: int) -> None:
        raise NotImplementedError("designs are made by an external tool")

    def record(self, line: dict) -> dict:
        return line


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], adapter: str | None):
        self.paths, self.adapter = paths, adapter

    def partitions(self):
        return [_File(p) for p in self.paths]

    def read(self, partition) -> Iterator[tuple]:
        if self.adapter:
            module, _, name = self.adapter.rpartition(".")
            adapter = getattr(importlib.import_module(module), name)()
        else:
            adapter = JsonLines()
        for line in read_text(partition.path).splitlines():
            if line.strip():
                row = {c: schema.DEFAULTS.get(c) for c in schema.COLUMNS} | adapter.record(json.loads(line))
                yield tuple(json.dumps(row[c]) if isinstance(row[c], dict | list) else row[c] for c in schema.COLUMNS)


class DesignSource(DataSource):
    """Format ``designs``: option ``path`` is a comma-separated list of files, ``adapter`` the dotted name of an adapter class."""

    @classmethod
    def name(cls) -> str:
        return "designs"

    def schema(self) -> T.StructType:
        return COLUMNS

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader([p for p in self.options.get("path", "").split(",") if p], self.options.get("adapter"))


def collect_designs(spark: SparkSession, paths: list[str], adapter: str | None = None) -> DataFrame:
    """Designs of a tool's files."""
    spark.dataSource.register(DesignSource)
    reader = spark.read.format("designs").option("path", ",".join(paths))
    return (reader.option("adapter", adapter) if adapter else reader).load()
