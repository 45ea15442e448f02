"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint has 64 bits: bit i is set if it is set in over half of the
XXH64 values (seed 42) of the text's word 3-shingles.  Two documents are
linked if their fingerprints differ in at most two bits.

Search.  A fingerprint is cut into 32 segments of two bits and mapped to
its popcounts, a point of {0,1,2}^32.  One bit changes one count by one, so
the Manhattan distance of two points never exceeds the Hamming distance.
The counts are kept in unary (a set count fills a segment from below), which
makes that distance one xor and one bit count.  The 32 axes form g groups;
points at distance two or less agree on g - 2 groups at least, so each point
is put into the grid cells named by g - 2 of the groups and met only with the
points of its cells.  Pairs pass the Manhattan bound first and are then
verified on the bits.  More groups make finer cells and more of them: g is
the least number, from five, by which ``FILL`` random points or fewer share
a point's cell (see ``grid``), so cells stay as small at any number of
documents, and work grows with that number.

Crowded cells.  Near copies share cells however fine the grid, and all pairs
of a cell grow with the square of its size.  Fingerprints of cells with
``CROWDED`` or more are linked exactly through midpoints: each names itself
and its 64 neighbours at one bit; two that differ in at most two bits share
such a midpoint, and two that share one differ in at most two.  A midpoint
has at most 65 fingerprints, so this way is exact and linear.

Equal fingerprints are one node, so exact copies cost one row each and no
pair.  Components come from ``graph.connected_components``.

Defined results: null and empty texts have fingerprint zero and are linked
like others; texts of under three words hash the whole word sequence; a
null id takes part in links but never names a component (a component of
null ids only has component_id null); an empty table gives an empty
result.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.graph import connected_components
from sievework.llm.names import column, fresh
from sievework.llm.workers import map_batches, slices
from sievework.plans.shared import materialize

SEED = 42
SHINGLE = 3
RADIUS = 2
#: Different fingerprints from which a cell is linked through midpoints.
CROWDED = 128
#: Ids and hashes to drop (eight bytes each) up to which they are broadcast.
BROADCAST_IDS = 1_000_000
#: Two-bit segments of a fingerprint, and random points that may share a point's cell on average.
SEGMENTS, FILL = 32, 16.0
_LOW = 0x5555555555555555


def fingerprint_text(text: str | None) -> int:
    """The fingerprint as a signed 64-bit integer."""
    import xxhash

    hashed = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        hashes = [hashed(joined, SEED)]
    else:
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        hashes = [hashed(joined[s:e], SEED) for s, e in zip(starts[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)]
    counts = np.zeros(64, dtype=np.int64)
    values = np.array(hashes, dtype="<u8")
    for at in range(0, len(values), 4096):
        bits = np.unpackbits(values[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(values), bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        found = [fingerprint_text(t) for t in part.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.int64()), part.column(2)], ["doc_id", "fp", "key"])


def _key(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col).cast("string"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, key) of every row, written once; ``key`` is a hash of the text."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), _key(text_col).alias("key"))
    return materialize(map_batches(narrow, _fingerprints, "doc_id long, fp long, key long"), "simhash")


def embed(fp: Column) -> Column:
    """Popcounts of the two-bit segments in unary: of each segment's bits, the set ones come first."""
    upper = F.shiftrightunsigned(fp, 1)
    low = F.lit(_LOW)
    return fp.bitwiseOR(upper).bitwiseAND(low).bitwiseOR(F.shiftleft(fp.bitwiseAND(upper).bitwiseAND(low), 1))


def manhattan(a: Column, b: Column) -> Column:
    """Manhattan distance of two embedded fingerprints."""
    return F.bit_count(a.bitwiseXOR(b))


def grid(points: int) -> list[tuple[int, int]]:
    """Groups of segments (first, number) for so many different fingerprints.

    Two random segments have equal popcounts with probability 3/8, so a cell
    that names s segments is shared by ``points * (3/8)**s`` random points.
    """
    for n in range(5, SEGMENTS + 1):
        cuts = [SEGMENTS * i // n for i in range(n + 1)]
        sizes = [b - a for a, b in zip(cuts, cuts[1:], strict=False)]
        if points * 0.375 ** sum(sorted(sizes)[: n - RADIUS]) <= FILL:
            break
    return list(zip(cuts, sizes, strict=False))


def _masks(groups: list[tuple[int, int]]) -> list[int]:
    masks = [((1 << (2 * n)) - 1) << (2 * at) for at, n in groups]
    signed = [sum(x) for x in combinations(masks, len(groups) - RADIUS)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in signed]


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) whose components are those of all links among the different values of ``fp``."""
    point = embed(F.col("fp"))
    masks = _masks(grid(distinct.count()))
    cells = materialize(distinct.select("fp", F.posexplode(F.array(*[point.bitwiseAND(F.lit(m)) for m in masks])).alias("part", "cell")), "simhash-cells")
    filled = cells.groupBy("part", "cell").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialize(cells.join(filled, ["part", "cell"]), "simhash-shared")
    few = shared.where(F.col("n") < CROWDED)
    left, right = few.select("part", "cell", F.col("fp").alias("a")), few.select("part", "cell", F.col("fp").alias("b"))
    near = (F.col("a") < F.col("b")) & (manhattan(embed(F.col("a")), embed(F.col("b"))) <= RADIUS)
    exact = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
    met = left.join(right, (left["part"] == right["part"]) & (left["cell"] == right["cell"]) & near & exact).select("a", "b")
    many = shared.where(F.col("n") >= CROWDED).select("fp").distinct()
    flips = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit((1 << i) - (1 << 64) if i == 63 else 1 << i)) for i in range(64)]
    middle = many.select("fp", F.explode(F.array(*flips)).alias("middle"))
    star = middle.groupBy("middle").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("of")).where(F.size("of") > 1)  # at most 65
    return met.union(star.select("a", F.explode("of").alias("b")).where("a <> b"))


def _rooted(prints: DataFrame) -> DataFrame:
    """(fp, first_id, root): the smallest doc_id of every fingerprint, and the fingerprint that its component is known by."""
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = connected_components(links(distinct.select("fp")), "a", "b").select(F.col("node").alias("fp"), "root")
    return materialize(distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "simhash-roots")


def components(prints: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) for rows (doc_id, fp); component_id is the smallest doc_id reachable."""
    rooted = _rooted(prints)
    named = rooted.join(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint in hex, component_id."""
    found = components(fingerprints(docs, id_col, text_col))
    return found.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without near-duplicates: of each component one row stays, the first by id (nulls last) and hash of the text.

    Rows are judged one by one, so rows that repeat an id, or have none, and
    differ in their texts are documents of their own.  Rows that agree in id
    and text are alike; one of them stays.

    Only ids and hashes are joined to the texts.  Up to ``BROADCAST_IDS`` of
    those to drop are sent to every executor, so that texts aren't shuffled;
    beyond, the join is a shuffled one.  Of the texts only those of rows that
    repeat an id and a text are shuffled.
    """
    prints = fingerprints(docs, id_col, text_col)
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key")
    rows = prints.groupBy("doc_id", "key", "fp").agg(F.count("*").alias("rows")).join(_rooted(prints).select("fp", "root"), "fp")
    rows = materialize(rows.select("root", "rows", place.alias("place")), "simhash-found")
    first = rows.groupBy("root").agg(F.min("place").alias("first"))
    told = materialize(rows.join(first, "root").select("place.*", "rows", (F.col("place") == F.col("first")).alias("head")), "simhash-ids")
    many = F.col("head") & (F.col("rows") > 1)
    counts = told.agg(F.count(F.when(~F.col("head"), True)).alias("drop"), F.count(F.when(many, True)).alias("many")).first()
    gone, key = fresh(docs, "gone_id", "gone_key")
    same = column(id_col).cast("long").eqNullSafe(F.col(gone)) & (F.xxhash64(column(text_col).cast("string")) == F.col(key))

    def named(which: Column, n: int) -> DataFrame:
        ids = told.where(which).select(F.col("doc_id").alias(gone), F.col("key").alias(key))
        return F.broadcast(ids) if n <= BROADCAST_IDS else ids

    kept = docs.join(named(~F.col("head"), counts["drop"]), same, "left_anti")
    if not counts["many"]:
        return kept
    repeated = named(many, counts["many"])
    alike = kept.join(repeated, same, "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(repeated, same, "left_anti").union(alike)
