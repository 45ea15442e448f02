"""Memory of Python workers, which Spark keeps for later tasks."""

from __future__ import annotations

import ctypes
import functools
import gc

import pyarrow as pa
from pyspark.sql.types import StructField, StructType


def release() -> None:
    """Give freed memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def tidy(run):
    """A function for mapInArrow that gives its memory back when a task ends."""

    @functools.wraps(run)
    def wrapped(batches):
        yield from run(batches)
        release()

    return wrapped


def slices(batches, rows: int = 256):
    """Batches cut into smaller ones, so that few texts are held as Python strings at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_batches(df, run, schema):
    """``df.mapInArrow`` by a function that gives its memory back; ``run`` cuts the batches with ``slices``, so the session's batch size stays the caller's."""
    return df.mapInArrow(tidy(run), schema)


def map_rows(df, run):
    """Whole rows through ``run`` in their own columns, which have places for names there: a name may hold any character."""
    plain = [f"c{i}" for i in range(len(df.columns))]
    fields = [StructField(n, f.dataType, f.nullable) for n, f in zip(plain, df.schema, strict=True)]
    return map_batches(df.toDF(*plain), run, StructType(fields)).toDF(*df.columns)
