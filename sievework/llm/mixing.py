"""Mixing sources to target weights by capped water-filling.

Every source gets a share of all words in proportion to its weight.  A
source whose share would exceed ``max_epochs`` times its own size is
clamped there, and the excess is spread over the others by weight until no
source is above its cap.  A source's documents are then repeated ``floor``
(target / size) times, and a seeded subset once more for the fraction.

Scale: the text is read once for (id, source, size, key); all else runs on
those narrow rows.  Water-filling needs three sums a round.  The seeded
order of a source is cut at one key; the cut is found from sums over
``BUCKETS`` hash ranges and from the rows of the one range it falls into,
so a source that holds a third of all rows is never gathered or sorted.
Rows that repeat both id and text share a key; where the cut falls among
them they are written and numbered by file and place, so a source of equal
rows is cut as finely as any other.

Defined results: a null or empty text has size 0 and takes 0 words; a null
source is a source of its own, last in the order; of rows that repeat both
id and text as many are taken as the cut asks for, whichever they are; an
empty table gives an empty result.  Input columns other than the named ones
are ignored and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework.functions.text import count_words
from sievework.llm.names import column
from sievework.plans.shared import materialize

#: Hash ranges of a source; the key has 63 bits, its upper 12 name the range.
BUCKETS = 4096
_SHIFT = 63 - 12
#: Rows of the table of sources up to which it is broadcast (about 100 bytes a row); a join by source beyond.
BROADCAST_SOURCES = 50_000


def _key(doc_id: Column, text: Column, seed: int) -> Column:
    """Seeded place of a document in its source's order: 63 bits from id and text."""
    return F.xxhash64(F.lit(seed), doc_id, text).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))


def _source_key(source: Column) -> Column:
    """A source as a join key; null has one of its own."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def document_sizes(docs: DataFrame, seed: int = 17) -> DataFrame:
    """Narrow rows (doc_id, source, size, key) of all documents, written once."""
    return materialize(
        docs.select(
            F.col("doc_id"),
            F.col("source"),
            count_words(F.col("text")).alias("size"),
            _key(F.col("doc_id"), F.col("text"), seed).alias("key"),
        ),
        "mix-sizes",
    )


def weigh_in_turn(totals: DataFrame, turn: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Weights 1, 2, 3, 1, ... by the sources' code points, null last.

    Ranks come from range partitions and their row counts, so no task holds
    all sources.
    """
    spark = totals.sparkSession
    parted = materialize(
        totals.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("_part", F.spark_partition_id()),
        "mix-ranges",
    )
    counts = {r["_part"]: r["n"] for r in parted.groupBy("_part").agg(F.count("*").alias("n")).collect()}  # a row a partition
    starts, so_far = [], 0
    for part in sorted(counts):
        starts.append((part, so_far))
        so_far += counts[part]
    offsets = spark.createDataFrame(starts, "_part int, _start long")
    ranked = parted.join(F.broadcast(offsets), "_part").withColumn(
        "_rank", F.col("_start") + F.row_number().over(Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last())) - 1
    )
    weight = F.element_at(F.array(*[F.lit(w) for w in turn]), (F.col("_rank") % len(turn) + 1).cast("int"))
    return ranked.withColumn("weight", weight.cast("double")).drop("_part", "_start", "_rank")


def fill_to_targets(totals: DataFrame, max_epochs: float = 3.0, share: float = 1.0) -> DataFrame:
    """Add ``target`` to rows (source, source_size, weight).

    Each round clamps the sources above their cap at the current level and
    raises the level of the rest; it ends when no further source is clamped.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    whole = totals.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w"), F.count("*").alias("n")).first()
    total, left, weight, clamped = (whole["s"] or 0) * share, (whole["s"] or 0) * share, whole["w"] or 0.0, 0
    while True:
        over = F.col("weight") * F.lit(float(left)) / F.lit(float(weight or 1.0)) > cap
        row = totals.agg(
            F.sum(F.when(over, cap)).alias("taken"), F.sum(F.when(~over, F.col("weight"))).alias("w"), F.count(F.when(over, True)).alias("n")
        ).first()
        if row["n"] <= clamped:
            break
        clamped, left, weight = row["n"], total - (row["taken"] or 0.0), row["w"] or 0.0
        if not weight:
            break
    level = F.col("weight") * F.lit(float(left)) / F.lit(float(weight or 1.0))
    return totals.withColumn("target", F.least(level, cap) if weight else cap)


def repetitions(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source (source_key, source_size, target, whole, cut, some): the plan.

    Every document is taken ``whole`` times, those with a key below ``cut``
    once more, and of the rows at it ``some`` once more; ``some`` is null if
    that is all of them.
    """
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = materialize(
        targets.select(
            _source_key(F.col("source")).alias("source_key"),
            F.col("source_size"),
            F.col("target"),
            F.floor(ratio).cast("int").alias("whole"),
            (F.col("target") - F.floor(ratio) * F.col("source_size")).alias("goal"),
        ),
        "mix-plan",
    )
    keyed = sizes.select(_source_key(F.col("source")).alias("source_key"), "size", "key", F.shiftright("key", _SHIFT).alias("bucket"))
    sums = keyed.groupBy("source_key", "bucket").agg(F.sum("size").alias("sum"))
    before = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most BUCKETS rows a source
    crossed = (F.col("before") <= F.col("goal")) & (F.col("goal") < F.col("before") + F.col("sum"))
    edge = sums.withColumn("before", F.coalesce(F.sum("sum").over(before), F.lit(0))).join(plan.select("source_key", "goal"), "source_key").where((F.col("goal") > 0) & crossed)
    inner = Window.partitionBy("source_key").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    inside = keyed.join(edge.select("source_key", "bucket", F.col("before").alias("start"), "goal"), ["source_key", "bucket"])
    inside = inside.groupBy("source_key", "start", "goal", "key").agg(F.sum("size").alias("sum"), F.count("*").alias("rows"))
    inside = inside.withColumn("before", F.col("start") + F.coalesce(F.sum("sum").over(inner), F.lit(0))).where(crossed)  # a row a source
    nearest = F.ceil((F.col("goal") - F.col("before")) * F.col("rows") / F.col("sum") - 0.5).cast("long")
    cut = inside.withColumn("some", nearest).select(
        "source_key",
        F.when(F.col("some") >= F.col("rows"), F.col("key") + 1).otherwise(F.col("key")).alias("cut"),
        F.when((F.col("some") > 0) & (F.col("some") < F.col("rows")), F.col("some")).alias("some"),
    )
    return materialize(plan.join(cut, "source_key", "left").select("source_key", "source_size", "target", "whole", F.coalesce("cut", F.lit(0)).alias("cut"), "some"), "mix-cuts")


def mixing_plan(docs: DataFrame, max_epochs: float = 3.0, seed: int = 17, weights: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(narrow rows, plan by source).  ``weights`` (source, weight) replaces the weights in turn."""
    sizes = document_sizes(docs, seed)
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    if weights is None:
        weighed = weigh_in_turn(totals)
    else:
        given = weights.select(_source_key(F.col("source")).alias("_k"), F.col("weight").cast("double").alias("weight"))
        weighed = totals.withColumn("_k", _source_key(F.col("source"))).join(given, "_k", "left").drop("_k").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    weighed = materialize(weighed.select("source", "source_size", "weight"), "mix-totals")
    return sizes, repetitions(sizes, fill_to_targets(weighed, max_epochs))


def _by_source(plan: DataFrame) -> DataFrame:
    return F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan


def _times(docs: DataFrame, source: Column, key: Column, plan: DataFrame) -> DataFrame:
    """(row, source_size, target, times) for rows that the mix judges; ``row`` holds the columns of ``docs``.

    Rows at a cut that takes some of them are written, and numbered by their
    files' rows before them and their place in the file; none is gathered.
    """
    row = F.struct(*[column(c).alias(c) for c in docs.columns])
    joined = docs.select(row.alias("row"), source.alias("source_key"), key.alias("key")).join(_by_source(plan), "source_key")
    split = F.col("some").isNotNull() & (F.col("key") == F.col("cut"))
    out = joined.where(~split).select("row", "source_size", "target", (F.col("whole") + (F.col("key") < F.col("cut")).cast("int")).alias("times"))
    if plan.where("some is not null").isEmpty():
        return out
    written = materialize(joined.where(split).select("row", "source_key", "source_size", "target", "whole", "some"), "mix-copies")
    placed = written.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    files = placed.groupBy("source_key", "file").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source_key").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    files = files.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    number = F.col("before") + F.row_number().over(Window.partitionBy("source_key", "file").orderBy("at"))  # the rows of one file
    numbered = placed.join(files, ["source_key", "file"]).withColumn("number", number)
    return out.union(numbered.select("row", "source_size", "target", (F.col("whole") + (F.col("number") <= F.col("some")).cast("int")).alias("times")))


def mix_report(docs: DataFrame, max_epochs: float = 3.0, seed: int = 17) -> DataFrame:
    """Per document: size, its source's size and target, and the words the mix takes of it, repeats counted."""
    sizes, plan = mixing_plan(docs, max_epochs, seed)
    judged = _times(sizes, _source_key(F.col("source")), F.col("key"), plan)
    return judged.select("row.doc_id", "row.size", "source_size", "target", (F.col("row.size") * F.col("times")).cast("long").alias("taken"))


def mix(docs: DataFrame, max_epochs: float = 3.0, seed: int = 17, weights: DataFrame | None = None) -> DataFrame:
    """The mixed documents: each row as often as the plan says, in its own columns.

    The text isn't shuffled, but for rows that a cut falls among: a row's key
    is computed again and held against its source's cut.
    """
    _, plan = mixing_plan(docs, max_epochs, seed, weights)
    judged = _times(docs, _source_key(F.col("source")), _key(F.col("doc_id"), F.col("text"), seed), plan)
    turns = judged.where("times > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("turn"))
    return turns.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
