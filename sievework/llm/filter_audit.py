"""How filters interact: what each removes in every order in which they could run.

Each document gets a mask with a bit for each of five filters it fails, by
built-in functions only:

A  under 50 words
B  100 * distinct words < 65 * words
C  100 * letters A-Z > 5 * code points
D  holds any of ``#$%&*|``
E  its text is that of a smaller doc_id, anywhere in the table

A group by text (its SHA-256) gives the smallest doc_id of each text; a
document fails E if it isn't that one.  The two are joined on text and id
together, so a text that a third of all rows share is no hot key.  Counts of
masks, 32 cells a part, hold all that is needed: from these the 120 orders
are enumerated, 600 rows a part.

Defined results: a null text is empty (no word, no repeated word, so A and
not B); a null source is the part of the empty string; rows with a null id
never fail E and don't make others fail; rows that repeat id and text don't
make each other fail E; a document is good or toxic if any row of ``labels``
with its id says so, with a null id never; an empty table gives no part.
Other columns aren't read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.text import let, words
from sievework.plans.shared import materialize

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 50, 65, 5, "#$%&*|"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def text_mask(text: Column) -> Column:
    """The bits of the filters that a text alone decides: 1, 2, 4, 8 for A to D."""
    bit = lambda failed, value: F.when(failed, value).otherwise(0)
    by_words = let(words(text), lambda w: bit(F.size(w) < LEAST_WORDS, 1) + bit(100 * F.size(F.array_distinct(w)) < LEAST_DISTINCT * F.size(w), 2))
    capitals = F.length(text) - F.length(_without(text, _CAPITALS))
    symbols = F.length(_without(text, SYMBOLS)) < F.length(text)
    return by_words + bit(100 * capitals > MOST_CAPITALS * F.length(text), 4) + bit(symbols, 8)


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(doc_id, part, mask) of every document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), part.alias("part"), text.alias("text"))
    rows = materialize(rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("content"), text_mask(F.col("text")).alias("mask")), "audit-rows")
    first = rows.groupBy("content").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    repeated = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return rows.join(first, ["content", "doc_id"], "left").select("doc_id", "part", (F.col("mask") + F.when(repeated, 16).otherwise(0)).alias("mask"))


def histogram(marked: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of every mask that occurs."""
    told = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c) for c in ("quality", "toxic")])
    sums = [F.sum(F.coalesce(c, F.lit(0))).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]
    return marked.join(told, "doc_id", "left").groupBy("part", "mask").agg(F.count("*").alias("n"), *sums)


def _orders() -> list[tuple[str, int, int, int]]:
    """(filter_order, step, bit, bits before it) of all steps of all orders."""
    bits = {f: 1 << i for i, f in enumerate(FILTERS)}
    return [("".join(p), i + 1, bits[p[i]], sum(bits[f] for f in p[:i])) for p in permutations(FILTERS) for i in range(len(p))]


def orders(cells: DataFrame) -> DataFrame:
    """Every step of every order of each part, from its cells.

    A filter removes the documents that fail it and nothing before it.  Over
    all orders, each of the k filters that a document fails comes first among
    them equally often, so it is counted 120 / k times for each.
    """
    spark, n_masks = cells.sparkSession, 1 << len(FILTERS)
    pick = lambda c, m: F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(c))), F.lit(0))
    parts = cells.groupBy("part").agg(*[F.array(*[pick(c, m) for m in range(n_masks)]).alias(c) for c in ("n", "good", "toxic")])
    steps = spark.createDataFrame(_orders(), "filter_order string, step int, bit int, earlier int")  # 600 rows
    steps = steps.agg(F.collect_list(F.struct("*")).alias("steps"))
    rows = parts.join(F.broadcast(steps)).select("part", "n", "good", "toxic", F.explode("steps").alias("s")).select("part", "n", "good", "toxic", "s.*")  # joined with one row
    cell = F.sequence(F.lit(0), F.lit(n_masks - 1))
    fails, before = lambda m: m.bitwiseAND(F.col("bit")) > 0, lambda m: m.bitwiseAND(F.col("earlier")) > 0
    total = lambda c, holds, times=lambda m: 1: F.aggregate(F.filter(cell, holds), F.lit(0).cast("long"), lambda s, m: s + F.element_at(c, m + 1) * times(m))
    removed = lambda m: fails(m) & ~before(m)
    share = lambda m: (F.lit(120) / F.bit_count(m)).cast("long")
    return rows.select(
        "part", "filter_order", "step",
        total("n", lambda m: ~fails(m) & ~before(m)).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda m: fails(m) & before(m)).alias("redundant"),
        F.element_at("n", F.col("bit") + 1).cast("long").alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        total("n", fails, share).alias("shapley"),
        F.substring("filter_order", F.col("step"), F.lit(1)).alias("filter"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All steps of all orders over ``docs``."""
    return orders(histogram(masks(docs), labels))
