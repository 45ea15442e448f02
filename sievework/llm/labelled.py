"""Words of a text, and labelled documents, all or a bounded sample, for the trained classifiers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.plans.shared import materialize

#: Letters, digits and underscores; anything else parts words.
WORD = re.compile(r"\w+")


def in_fold(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row is held out: crc32 of the id as text, modulo ``folds``, is 0; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def _graded(labels: DataFrame, label: Column) -> DataFrame:
    """(__id, __label) outside the held-out fold; ids with contradicting labels are left out."""
    graded = labels.select(F.col("doc_id").cast("long").alias("__id"), label.cast("int").alias("__label")).where("__id is not null and __label is not null")
    return graded.where(~in_fold(F.col("__id"))).groupBy("__id").agg(F.min("__label").alias("__label"), F.max("__label").alias("__other")).where("__label = __other")


def labelled(docs: DataFrame, labels: DataFrame, label: Column, id_col="doc_id", text_col="text", extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows (id, label, text, *extra) of all labelled documents outside the held-out fold, written once; of documents with one id the least."""
    graded = _graded(labels, label).select("__id", "__label")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = docs.select(F.col(id_col).cast("long").alias("__id"), F.struct(text.alias("text"), *[F.col(c).alias(c) for c in extra]).alias("r"))
    picked = found.join(graded, "__id").groupBy("__id", "__label").agg(F.min("r").alias("r"))
    return materialize(picked.select(F.col("__id").alias("id"), F.col("__label").alias("label"), "r.*"), "labelled")


def sample_labelled(docs: DataFrame, labels: DataFrame, label: Column, per_class: dict[int, int], max_chars: int, id_col="doc_id", text_col="text", extra: tuple[str, ...] = ()) -> list[tuple]:
    """Rows (label, text, *extra) of labelled documents outside the held-out fold, at most ``per_class`` of each label and ``max_chars`` in all.

    Ids are taken in a seeded order, so the choice doesn't depend on how
    the tables are laid out.  Ids with contradicting labels and documents
    that would pass the bound of characters are skipped; texts are whole.
    The chosen rows are written, so the texts are read once.
    """
    graded = _graded(labels, label)
    order = F.xxhash64(F.lit("sample"), F.col("__id"))
    chosen = None
    for value, n in per_class.items():
        part = graded.where(F.col("__label") == value).select("__id", "__label").orderBy(order, "__id").limit(n)
        chosen = part if chosen is None else chosen.union(part)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = docs.select(F.col(id_col).cast("long").alias("__id"), text.alias("__text"), *[F.col(c).alias(f"__x{i}") for i, c in enumerate(extra)])
    names = ["__text", *[f"__x{i}" for i in range(len(extra))]]
    picked = found.join(F.broadcast(chosen), "__id").groupBy("__id", "__label").agg(F.min(F.struct(*names)).alias("r"))  # at most the sum of per_class rows
    picked = materialize(picked, "labelled")
    sizes = picked.select("__id", F.length("r.__text").alias("n")).orderBy(order, "__id").collect()
    ids, left = [], max_chars
    for row in sizes:
        if row["n"] <= left:
            ids.append((row["__id"],))
            left -= row["n"]
    if not ids:
        return []
    rows = picked.join(F.broadcast(docs.sparkSession.createDataFrame(ids, "__id long")), "__id").select("__id", "__label", "r.*").collect()
    rows.sort(key=lambda r: r["__id"])
    return [(r["__label"], *[r[n] for n in names]) for r in rows]
