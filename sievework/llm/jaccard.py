"""Near-duplicate sets of word n-grams by a grouped prefix join.

A document is the set of its distinct word 4-shingles; two are linked if
their Jaccard similarity is 0.85 or more.  Shingles are 64-bit hashes.

Collapse.  Documents with equal sets are one node (a 128-bit digest of the
set).  All documents agree on an order of the shingles, rare ones first: by
counts in a table of ``cells`` cells over every shingle of every document,
then by hash.  Linked sets share a shingle among their first ``s - ceil(0.85
s) + 1`` in that order, so only these prefixes are joined; nodes with one
prefix and one size are one group, met as one row.

Filter.  Two groups that share a prefix shingle are a candidate if their
sizes allow the similarity and the shingles from the shared one on can still
reach the overlap.  A shingle that a family of near copies shares would make
all pairs of the family.  Only components are wanted, so the first rounds
meet, in every shingle's bucket, each group with one pivot: the group whose
prefix reaches furthest into frequent shingles, which is the text the copies
were made from.  What these links leave open is met afterwards: in each
bucket, all groups outside its most frequent component, with everything of
another component.  Pairs inside a component can't change the result, so it
is exact.

Expand and verify.  Candidate groups are expanded to their members.  A set's
counts of hashes by range bound the overlap of two sets from above, at a
thirtieth of the sets' size; the pairs that stay possible are counted on the
whole sets.

Defined results: a text without words, or null, has an empty set and is
linked with nothing; under four words the whole sequence is one shingle;
rows that repeat an id are documents of their own; a null id takes part in
links but never names a component (a component of null ids only has
component_id null); an empty table gives an empty result.  Only the two
named columns are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.graph import connected_components
from sievework.llm.workers import map_batches, slices
from sievework.plans.shared import materialize

SHINGLE = 4
#: Similarity in hundredths.
THRESHOLD = 85
#: Cells of the table of counts that orders the shingles.
CELLS = 1 << 20
#: Bytes of a text that are hashed at once, about: a block ends with a word.
BLOCK = 1 << 20
#: Node ids up to which they are broadcast to fetch the candidates' texts; beyond, the join is a shuffled one.
BROADCAST_NODES = 250_000
#: Rounds of pivots go on while the pairs that are left open are more than so many times the rows of all buckets.
OPEN = 4
#: Bits of a token that its hash has; the twelve above hold its place in the order.
HASH_BITS = 51
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


#: Base of the words' polynomials, and its inverse.
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(value of each byte, A-Z as a-z; whether it is white space; powers of the base; of its inverse)."""
    values = np.frombuffer(np.random.default_rng(42).bytes(256 * 8), dtype=np.uint64).copy()
    values[65:91] = values[97:123]
    space = np.zeros(256, dtype=bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    values[space] = 0
    return values, space, _powers(_BASE, BLOCK + 1), _powers(_INVERSE, BLOCK + 1)


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


def _mixed(h: np.ndarray) -> np.ndarray:
    for shift, factor in ((31, 0x7FB5D329728EA185), (27, 0x81DADEF4BC2DD44D)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    h ^= h >> np.uint64(33)
    return h


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text in UTF-8, A-Z as a-z: a polynomial of its bytes' values and its length, mixed."""
    values, space, powers, inverse = _tables()
    every, found, at = np.frombuffer(data, dtype=np.uint8), [], 0
    while at < len(every):
        end = min(at + BLOCK, len(every))
        if end < len(every):  # on to the end of the word
            after = np.flatnonzero(space[every[end : end + BLOCK]])
            while not len(after) and end < len(every):
                end = min(end + BLOCK, len(every))
                after = np.flatnonzero(space[every[end : end + BLOCK]])
            end += int(after[0]) if len(after) else 0
        part, at = every[at:end], end
        inside = np.concatenate([[False], ~space[part], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        if len(part) > len(powers) - 1:  # a word longer than a block
            powers, inverse = _powers(_BASE, len(part) + 1), _powers(_INVERSE, len(part) + 1)
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values[part] * powers[: len(part)], dtype=np.uint64)])
        found.append(_mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _MIX[0]))
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint64)


def shingles(data: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; the text in UTF-8."""
    h = word_hashes(data or b"")
    if not len(h):
        return h
    width = min(len(h), SHINGLE)
    mixed = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        mixed += h[i : i + len(mixed)] * _MIX[i]
    mixed = np.sort(_mixed(mixed))
    return mixed[np.concatenate([[True], mixed[1:] != mixed[:-1]])]


def counts_by_range(found: np.ndarray) -> bytes | None:
    """How many hashes of a set lie in each of 2**k equal ranges, four to eight on average; a byte each; None if one has more than 255."""
    k = max(0, len(found).bit_length() - 3)
    counts = np.bincount((found >> np.uint64(64 - k)).astype(np.int64), minlength=1 << k) if k else np.array([len(found)])
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else None


def may_overlap(a: bytes | None, b: bytes | None, threshold: int = THRESHOLD) -> bool:
    """Whether two sets can be similar enough by their counts: in no range do they share more than the smaller count."""
    if a is None or b is None:
        return True
    x, y = (np.frombuffer(h, dtype=np.uint8).astype(np.int64) for h in (a, b))
    total = int(x.sum() + y.sum())
    n = min(len(x), len(y))
    shared = int(np.minimum(x.reshape(n, -1).sum(1), y.reshape(n, -1).sum(1)).sum())
    return (100 + threshold) * shared >= threshold * total


def prefix_length(size: int, threshold: int = THRESHOLD) -> int:
    """Shingles, first in the common order, of which linked sets share one."""
    return size - -(-threshold * size // 100) + 1


def _need(a: Column, b: Column, threshold: int) -> Column:
    """The least overlap of linked sets of two sizes."""
    return ((threshold * (a + b) + (99 + threshold)) / (100 + threshold)).cast("long")


def _node(found: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh128_digest(found.tobytes())


def _describe(cells: int):
    """(doc_id, key, n_shingles, node) of every row, and one row a task with its counts of shingles by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, names = np.zeros(cells, dtype=np.int64), ["doc_id", "key", "n_shingles", "node", "counts"]
        for part in slices(batches):
            sets = [shingles(t) for t in part.column(2).to_pylist()]
            counts += np.bincount((np.concatenate(sets) & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
            columns = [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([_node(s) if len(s) else None for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(sets), pa.list_(pa.int64()))], names)
        if counts.any():
            yield pa.RecordBatch.from_arrays([*[pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())], pa.array([counts], pa.list_(pa.int64()))], names)

    return run


def _prefixes(order: np.ndarray, threshold: int):
    """(node, size, grp, tokens, ranges): a set's first shingles in the common order, whose place is in a token's upper bits, and its counts by range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        places, low = order.astype(np.uint64) << np.uint64(HASH_BITS), np.uint64((1 << HASH_BITS) - 1)
        for part in slices(batches):
            rows = []
            for text in part.column(0).to_pylist():
                found = shingles(text)
                if not len(found):
                    continue
                n = prefix_length(len(found), threshold)
                token = places[(found & np.uint64(len(order) - 1)).astype(np.int64)] | (found & low)
                token = np.sort(np.partition(token, n - 1)[:n]).astype(np.int64)
                rows.append((_node(found), len(found), xxhash.xxh64_intdigest(token.tobytes(), len(found)), token, counts_by_range(found)))
            a, b, c, d, e = zip(*rows, strict=True) if rows else ((), (), (), (), ())
            grp = pa.array(np.array(c, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.int64()), grp, pa.array(d, pa.list_(pa.int64())), pa.array(e, pa.binary())], ["node", "size", "grp", "tokens", "ranges"])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        sets = [shingles(t) for t in part.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([_node(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), part.column(1)], ["node", "held", "alike"])


def _possible(threshold: int):
    """Pairs (a, a_comp, b, b_comp) whose counts by range allow the similarity; the counts come in the last two columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 4096):
            fine = [may_overlap(x, y, threshold) for x, y in zip(part.column(4).to_pylist(), part.column(5).to_pylist(), strict=True)]
            yield part.filter(pa.array(fine, pa.bool_())).select(["a", "a_comp", "b", "b_comp"])

    return run


def _order(described: DataFrame, cells: int) -> np.ndarray:
    """A place from 0 to 4095 for each cell, by the logarithm of its count; a fixed number of cells reaches the driver."""
    summed = described.where("counts is not null").select(F.posexplode("counts").alias("cell", "n")).where("n > 0").groupBy("cell").agg(F.sum("n").alias("n"))
    place = F.least(F.floor(128 * F.log2(F.col("n") + 1.0)), F.lit(4095)).cast("short")
    table, order = summed.select("cell", place.alias("place")).toArrow(), np.zeros(cells, dtype=np.uint16)
    order[table["cell"].to_numpy()] = table["place"].to_numpy()
    return order


def _may_link(threshold: int) -> Column:
    """Whether two groups (a_size, a_pos, b_size, b_pos) that share a shingle at these places can be linked."""
    a, b = F.col("a_size"), F.col("b_size")
    fits = (100 * a >= threshold * b) & (100 * b >= threshold * a)
    return fits & (F.least(a - F.col("a_pos"), b - F.col("b_pos")) >= _need(a, b, threshold))


def _sides(rows: DataFrame, side: str, *names: str) -> DataFrame:
    return rows.select("token", *[F.col(n).alias(f"{side}_{n}") for n in names])


def _pivot_pairs(buckets: DataFrame, threshold: int, outside: bool) -> DataFrame:
    """Pairs (a_grp, b_grp): in each bucket one pivot, from outside the most frequent component if asked for, with every group of another component."""
    place = F.struct("last", "grp", "size", "pos", "comp")
    pivots = buckets.groupBy("token").agg(F.max(F.when(F.col("outside"), place) if outside else place).alias("p"))
    chosen = pivots.select("token", *[F.col(f"p.{n}").alias(f"a_{n}") for n in ("grp", "size", "pos", "comp")])
    met = chosen.join(_sides(buckets, "b", "grp", "size", "pos", "comp"), "token")
    return met.where((F.col("a_grp") != F.col("b_grp")) & ~F.coalesce(F.col("a_comp") == F.col("b_comp"), F.lit(False)) & _may_link(threshold)).select("a_grp", "b_grp").distinct()


def _open_pairs(buckets: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a_grp, b_grp): in each bucket the groups outside its most frequent component, with all of another one."""
    a, b = _sides(buckets.where("outside"), "a", "grp", "size", "pos", "comp"), _sides(buckets, "b", "grp", "size", "pos", "comp", "outside")
    new = ~F.coalesce(F.col("a_comp") == F.col("b_comp"), F.lit(False))
    once = (F.col("a_grp") != F.col("b_grp")) & (~F.col("b_outside") | (F.col("a_grp") < F.col("b_grp")))
    return a.join(b, "token").where(new & once & _may_link(threshold)).select("a_grp", "b_grp").distinct()


def _marked(shared: DataFrame, state: DataFrame) -> tuple[DataFrame, int, int]:
    """Buckets with each group's component (null while its members differ), whether it is outside its bucket's most frequent one; rows, and pairs left open."""
    of_group = state.groupBy("grp").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).select("grp", F.when(F.col("low") == F.col("high"), F.col("low")).alias("comp"))
    placed = materialize(shared.join(of_group, "grp"), "jaccard-buckets")
    counted = placed.groupBy("token", "comp").agg(F.count("*").alias("n"))
    main = counted.groupBy("token").agg(F.sum("n").alias("all"), F.max(F.when(F.col("comp").isNotNull(), F.struct("n", "comp"))).alias("main"))
    main = main.withColumn("rest", F.col("all") - F.coalesce("main.n", F.lit(0))).where("rest > 0")
    size = main.agg(F.sum("all").alias("rows"), F.sum(F.col("rest") * F.col("all")).alias("open")).first()
    buckets = placed.join(main.select("token", F.col("main.comp").alias("most")), "token").withColumn("outside", ~F.coalesce(F.col("comp") == F.col("most"), F.lit(False))).drop("most")
    return buckets, size["rows"] or 0, size["open"] or 0


def _within(state: DataFrame, every: bool) -> DataFrame:
    """Pairs of nodes of one group that aren't in one component: of its first node with each, or of all outside the first's component with each."""
    first = state.groupBy("grp").agg(F.min(F.struct("node", "comp")).alias("f"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("grp", F.col("f.node").alias("a"), F.col("f.comp").alias("a_comp"))
    others = state.select("grp", F.col("node").alias("b"), F.col("comp").alias("b_comp"))
    if not every:
        return others.join(first, "grp").where("a_comp <> b_comp").select("a", "a_comp", "b", "b_comp")
    most = first.select("grp", F.col("a_comp").alias("most"))
    rest = state.join(most, "grp").where("comp <> most").select("grp", F.col("node").alias("a"), F.col("comp").alias("a_comp"), "most")
    return rest.join(others, "grp").where((F.col("a_comp") != F.col("b_comp")) & ((F.col("b_comp") == F.col("most")) | (F.col("a") < F.col("b")))).select("a", "a_comp", "b", "b_comp")


def _expanded(pairs: DataFrame, state: DataFrame, every: bool) -> DataFrame:
    """Pairs of nodes in different components: all members of both groups, or the first of the one with all of the other."""
    left = state if every else state.groupBy("grp").agg(F.min(F.struct("node", "comp")).alias("f")).select("grp", "f.*")
    a = left.select(F.col("grp").alias("a_grp"), F.col("node").alias("a"), F.col("comp").alias("a_comp"))
    b = state.select(F.col("grp").alias("b_grp"), F.col("node").alias("b"), F.col("comp").alias("b_comp"))
    return pairs.join(b, "b_grp").join(a, "a_grp").where("a_comp <> b_comp").select("a", "a_comp", "b", "b_comp")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Edges (a, b) between the components of the pairs whose sets are similar enough."""
    both = pairs.join(sets.select(F.col("node").alias("b"), F.col("held").alias("b_held")), "b").join(sets.select(F.col("node").alias("a"), F.col("held").alias("a_held")), "a")
    sizes = F.size("a_held").cast("long"), F.size("b_held").cast("long")
    linked = both.where(F.size(F.array_intersect("a_held", "b_held")) >= _need(*sizes, threshold))
    return materialize(linked.select(F.col("a_comp").alias("a"), F.col("b_comp").alias("b")), "jaccard-edges")


def _linked(nodes: DataFrame, fetch, threshold: int) -> DataFrame:
    """(node, root) of the nodes that may have a link, from rows (node, size, grp, tokens, last, ranges) that may repeat a node."""
    groups = nodes.groupBy("grp").agg(F.first("size").alias("size"), F.first("last").alias("last"), (F.min("node") != F.max("node")).alias("several"))
    rows = nodes.select("grp", F.posexplode("tokens").alias("pos", "token"))
    common = rows.groupBy("token").agg(F.count("*").alias("n")).where("n > 1").select("token")
    met = materialize(rows.join(common, "token").groupBy("token", "grp").agg(F.min("pos").alias("pos")), "jaccard-met")
    common = met.groupBy("token").agg(F.count("*").alias("n")).where("n > 1").select("token")  # copies of one group aside
    shared = materialize(met.join(common, "token").join(groups.drop("several"), "grp"), "jaccard-shared")
    wanted = shared.select("grp").union(groups.where("several").select("grp")).distinct()
    live = materialize(nodes.groupBy("node").agg(F.first("grp").alias("grp"), F.first("ranges").alias("ranges")).join(wanted, "grp"), "jaccard-live")
    ranges = {side: live.select(F.col("node").alias(side), F.col("ranges").alias(f"{side}_ranges")) for side in "ab"}
    state, before = live.select("node", "grp", F.col("node").alias("comp")), None
    while True:
        buckets, size, still = _marked(shared, state)
        every = before is not None and (still <= OPEN * size or still > 0.9 * before)
        found = _open_pairs(buckets, threshold) if every else _pivot_pairs(buckets, threshold, before is not None)
        pairs = materialize(_expanded(found, state, every).union(_within(state, every)).distinct(), "jaccard-pairs")
        told = pairs.join(ranges["b"], "b").join(ranges["a"], "a").select("a", "a_comp", "b", "b_comp", "a_ranges", "b_ranges")
        pairs = materialize(map_batches(told, _possible(threshold), "a binary, a_comp binary, b binary, b_comp binary"), "jaccard-possible")
        if not pairs.isEmpty():
            sets = fetch(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
            roots = connected_components(_verified(pairs, sets, threshold), "a", "b").withColumnRenamed("node", "comp")
            state = materialize(state.join(roots, "comp", "left").select("node", "grp", F.coalesce("root", "comp").alias("comp")), "jaccard-state")
        if every:
            return state.select("node", F.col("comp").alias("root"))
        before = still


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, cells: int = CELLS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.cast("binary").alias("text"))
    described = materialize(map_batches(narrow, _describe(cells), "doc_id long, key long, n_shingles long, node binary, counts array<long>"), "jaccard-rows")
    rows = described.where("n_shingles is not null").drop("counts")
    order = _order(described, cells)
    found = map_batches(narrow.select("text"), _prefixes(order, threshold), "node binary, size long, grp long, tokens array<long>, ranges binary")
    nodes = materialize(found.withColumn("last", F.element_at("tokens", -1)), "jaccard-nodes")
    alike = rows.where("node is not null").groupBy("node", "doc_id", "key").agg(F.count("*").alias("alike"))
    named = materialize(alike.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min(F.struct("doc_id", "key", "alike")).alias("at")), "jaccard-named")

    def fetch(wanted: DataFrame) -> DataFrame:
        """(node, held): the sets of some nodes, from one document each."""
        at = materialize(named.join(wanted, "node").select(F.col("at.doc_id").alias("at_id"), F.col("at.key").alias("at_key"), F.col("at.alike").alias("alike")), "jaccard-wanted")
        few = F.broadcast(at) if at.count() <= BROADCAST_NODES else at
        texts = narrow.join(few, F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.col("key") == F.col("at_key"))).select("text", "alike")
        sets = materialize(map_batches(texts, _sets, "node binary, held array<long>, alike long"), "jaccard-sets")
        if at.where("alike > 1").isEmpty():
            return sets
        return sets.where("alike = 1").select("node", "held").union(sets.where("alike > 1").groupBy("node").agg(F.first("held").alias("held")))  # rows alike in id and text

    roots = _linked(nodes, fetch, threshold)
    rooted = materialize(named.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "jaccard-roots")
    component = rooted.join(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "root").select("node", "component_id")
    return rows.join(component, "node", "left").select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
