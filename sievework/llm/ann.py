"""Approximate nearest neighbours by an inverted file with product-quantised residuals.

Index.  Coarse centroids and the codebooks of the residuals (``PARTS``
sub-vectors, up to 256 words each) are fitted with numpy on a bounded
sample of ``SAMPLE`` vectors' directions; then every vector is assigned to
the nearest centroid of its direction and its residual, divided by its
list's root mean square so that dense lists are told apart as finely as wide
ones, is coded in ``PARTS`` bytes.  Kept with the code are the vector's
length and the length of what the code misses.

Search.  A query visits the ``probes`` lists whose centroids, times their
vectors' mean length, have the largest inner product with it.  Within them
the inner product is estimated from asymmetric distance tables (the query
isn't quantised), and the best ``RERANK`` of a shard are scored on the
original vectors in double precision.  Then bounds take over: by what the
code misses, a row's inner product can't pass a limit, and all rows whose
limit reaches the score of the (k + 1)-th are scored too.  In the same way a
list's angle and largest length limit its rows, and a second pass visits
every further list that could hold a better row.  So nothing is missed, on
whatever rows: the sample, ``probes`` and ``RERANK`` decide speed only.
``probes`` is set by measurement: for a bounded sample of queries the true
neighbours are found among all rows, and the least number of lists that
holds ``RECALL`` of them is taken.  A query whose lists hold fewer than
``k + 1`` rows goes on to further ones.

Equal vectors are one index row with the ``k + 1`` smallest ids; more can't
be returned to any query, since ties go to smaller ids.  So a vector that a
third of all rows share is searched and scored once.

Scale: lists are packed into shards of about ``SHARD`` rows, long lists are
split, and the queries of a shard come in blocks of ``BLOCK``; a task holds
one shard and one block.  Each (query, shard) returns ``k + 1`` rows at
most.  Lists grow as the square root of the rows up to a sixteenth of the
sample, which is what a bounded sample can place; beyond, lists grow and take
more shards.  Work grows as queries times the share of rows visited, which is
small on clustered vectors and large on vectors without structure.  Who needs
more lists passes a larger ``sample``; ``exact`` visits all lists and scores
all rows at once.

Scores are inner products in double precision of the vectors as they are
stored, floats or doubles; the index alone works on directions, and on lengths
in units of the largest component.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components, and vectors of another length than the most common
one (the longer of equally common ones), take no part; a null id takes no
part; rows that repeat id and vector count once; ties of scores go to the
smaller id; with fewer candidates than k all are returned; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework.llm.names import column
from sievework.llm.workers import slices
from sievework.plans.shared import materialize

#: Vectors the index is fitted on, queries that set the number of lists visited.
SAMPLE, CALIBRATION = 20_000, 128
PARTS = 16
RECALL = 0.98
RERANK = 256
SHARD, BLOCK = 16_384, 8_192
#: Sampled vectors a list at least.
PER_LIST = 16
RESULT = "query_id long, rank int, vec_id long, score double"


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, summed in the order of the components."""
    total = np.zeros(np.broadcast_shapes(a.shape[:-1], b.shape[:-1]))
    for j in range(a.shape[-1]):
        total += a[..., j].astype(np.float64) * b[..., j].astype(np.float64)
    return total


def nearest_centroid(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    norms = 0.5 * (centroids * centroids).sum(1)
    return np.concatenate([np.argmax(x[i : i + 4096] @ centroids.T - norms, axis=1) for i in range(0, len(x), 4096)] or [np.zeros(0, int)])


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Centroids of Lloyd's rounds from a seeded choice of rows; an empty cluster takes a seeded row."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    centroids = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = nearest_centroid(x, centroids)
        count = np.bincount(near, minlength=k)
        total = np.zeros((k, x.shape[1]))
        np.add.at(total, near, x)
        centroids = (total / np.maximum(count, 1)[:, None]).astype(x.dtype)
        if (empty := np.flatnonzero(count == 0)).size:
            centroids[empty] = x[rng.choice(len(x), empty.size)]
    return centroids


class Index:
    """Coarse centroids and residual codebooks."""

    def __init__(self, sample: np.ndarray, norms: np.ndarray, lists: int):
        self.centroids = kmeans(sample, lists)
        near = nearest_centroid(sample, self.centroids)
        held = np.bincount(near, minlength=len(self.centroids))
        self.weight = np.where(held > 0, np.bincount(near, norms, len(self.centroids)) / np.maximum(held, 1), norms.mean())
        length = np.linalg.norm(self.centroids.astype(np.float64), axis=1)
        self.axes, self.aimless = self.centroids / np.maximum(length, 1e-6)[:, None], length < 1e-6
        rest = sample - self.centroids[near]
        square = np.bincount(near, (rest * rest).sum(1), minlength=len(self.centroids)) / np.maximum(np.bincount(near, minlength=len(self.centroids)), 1)
        self.scale = np.sqrt(np.where(square > 0, square, (rest * rest).sum(1).mean() or 1.0)).astype(np.float32)
        rest = rest / self.scale[near][:, None]
        self.dim = sample.shape[1]
        self.cuts = [(int(c[0]), int(c[-1]) + 1) for c in np.array_split(np.arange(self.dim), min(PARTS, self.dim))]
        self.books = [kmeans(np.ascontiguousarray(rest[:, a:b]), 256, rounds=6, seed=7 + a) for a, b in self.cuts]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, length of what the code misses, angle to the list's axis) of directions."""
        y = x.astype(np.float32)
        near = nearest_centroid(y, self.centroids)
        rest = (y - self.centroids[near]) / self.scale[near][:, None]
        codes = np.stack([nearest_centroid(rest[:, a:b], book) for (a, b), book in zip(self.cuts, self.books, strict=True)], axis=1).astype(np.uint8)
        for part, ((a, b), book) in enumerate(zip(self.cuts, self.books, strict=True)):
            rest[:, a:b] -= book[codes[:, part]]
        missed = np.linalg.norm(rest, axis=1).astype(np.float64) * self.scale[near]
        angle = np.arccos(np.clip((x * self.axes[near]).sum(1), -1, 1))
        return near, codes, missed, np.where(self.aimless[near], np.pi, angle)

    def probe(self, q: np.ndarray, probes: int) -> np.ndarray:
        """Lists to visit, best first."""
        return np.argsort(-(q @ self.centroids.T) * self.weight, axis=1, kind="stable")[:, :probes]

    def limits(self, q: np.ndarray, angle: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """What no inner product of directions q with a list's rows passes, by the lists' widest angle and least and greatest length."""
        apart = np.where(self.aimless, 0, np.arccos(np.clip(q @ self.axes.T, -1, 1)))
        cosine = np.cos(np.maximum(apart - angle - 1e-6, 0)) + 1e-12
        return cosine * np.where(cosine >= 0, most, least)

    def tables(self, q: np.ndarray) -> list[np.ndarray]:
        """Asymmetric tables: inner products of each query's sub-vectors with the words of each book."""
        return [q[:, a:b] @ book.T for (a, b), book in zip(self.cuts, self.books, strict=True)]


def _vectors(array: pa.Array, dim: int) -> np.ndarray:
    """Rows of an array of vectors in their own precision."""
    return array.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _directions(x: np.ndarray, unit: float) -> tuple[np.ndarray, np.ndarray]:
    """(directions, lengths in units) of rows that aren't zero, in double precision."""
    x = x.astype(np.float64)
    peak = np.abs(x).max(axis=1, initial=0)
    x = x / peak[:, None]
    length = np.sqrt((x * x).sum(1))
    return x / length[:, None], peak / unit * length


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:k]


def as_vector(table: DataFrame, vector_col: str) -> Column:
    """The vectors: floats stay floats, all else is doubles."""
    kind = table.select(column(vector_col).alias("v")).schema["v"].dataType.simpleString()
    return column(vector_col).cast("array<float>" if kind == "array<float>" else "array<double>")


def valid_vectors(table: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """((vec_id, v) of the vectors that take part, their length)."""
    v = as_vector(table, vector_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = table.select(column(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
    common = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = common["dim"] if common else 0
    return rows.where(F.size("v") == dim), dim


def _calibrate(base: DataFrame, asked: DataFrame, index: Index, k: int, unit: float) -> int:
    """Lists to visit: the least number that holds ``RECALL`` of the true neighbours of a sample of queries."""
    rows = asked.orderBy(F.xxhash64("key")).limit(CALIBRATION).toPandas()  # a bounded sample
    q, keys, dim = _directions(np.stack(rows["v"].map(np.asarray)), unit)[0], rows["key"].to_numpy(), index.dim

    def run(batches):
        best = [(np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(q)
        for batch in slices(batches, 4096):
            (x, norms), ids = _directions(_vectors(batch.column("v"), dim), unit), batch.column("key").to_numpy()
            near = nearest_centroid(x.astype(np.float32), index.centroids)
            for i, scores in enumerate(q @ x.T * norms):
                scores = np.where(ids == keys[i], -np.inf, scores)
                part = np.argpartition(-scores, min(k, len(scores) - 1))[:k]
                s, n = np.concatenate([best[i][0], scores[part]]), np.concatenate([best[i][1], near[part]])
                d = np.concatenate([best[i][2], ids[part]])
                top = _top(s, d, k)
                best[i] = (s[top], n[top], d[top])
        for i, (s, n, d) in enumerate(best):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), i), pa.int32()), pa.array(s, pa.float64()), pa.array(n, pa.int32()), pa.array(d, pa.int64())], ["q", "score", "list", "key"])

    found = base.select("key", "v").mapInArrow(run, "q int, score double, list int, key long").where(F.col("score") > float("-inf"))
    nearest = Window.partitionBy("q").orderBy(F.desc("score"), "key")  # limited before it is shuffled
    found = found.withColumn("at", F.row_number().over(nearest)).where(F.col("at") <= k).select("q", "list").toPandas()  # CALIBRATION * k rows at most
    order = np.argsort(index.probe(q, len(index.centroids)), axis=1)
    places = order[found["q"].to_numpy(), found["list"].to_numpy()]
    return int(np.quantile(places, RECALL, method="higher")) + 1 if len(places) else 1


def visited(index: Index, q: np.ndarray, sizes: np.ndarray, probes: int, least: int) -> list[list[int]]:
    """Lists that each query visits: the ``probes`` nearest, and further ones until they hold ``least`` rows."""
    order = index.probe(q, len(index.centroids))
    enough = (np.cumsum(sizes[order], axis=1) < least).sum(axis=1) + 1
    return [row[: max(probes, n)].tolist() for row, n in zip(order, enough, strict=True)]


def _shards(counts: dict[int, int]) -> dict[int, list[int]]:
    """Shards of every list: short lists are packed together, long ones split."""
    out, shard, room = {}, 0, SHARD
    for number, n in sorted(counts.items()):
        if n > room and room < SHARD:
            shard, room = shard + 1, SHARD
        if n > SHARD:
            pieces = -(-n // SHARD)
            out[number] = list(range(shard, shard + pieces))
            shard, room = shard + pieces, SHARD
        else:
            out[number], room = [shard], room - n
    return out


def search(table: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = SAMPLE, exact: bool = False) -> DataFrame:
    """The ``k`` nearest rows of every query row: (query_id, rank, vec_id, score).

    ``is_query`` is a condition on the columns of ``table``, the id under
    its own name.  ``sample`` bounds the vectors the index is fitted on;
    with ``exact`` every list is visited and every row scored.
    """
    spark = table.sparkSession
    rows, dim = valid_vectors(table, id_col, vector_col)
    kind = rows.schema["v"].dataType.simpleString()
    few = Window.partitionBy("v").orderBy("vec_id")
    base = materialize(
        rows.withColumn("at", F.dense_rank().over(few)).where(F.col("at") <= k + 1)  # limited before it is shuffled
        .groupBy("v").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")).select(F.col("ids")[0].alias("key"), "ids", "v"), "ann-base"
    )
    n = base.count()
    if not n:
        return spark.createDataFrame([], RESULT)
    wanted = table.where(is_query).select(column(id_col).cast("long").alias("query_id"), as_vector(table, vector_col).alias("v"))
    queries = materialize(wanted.where("query_id is not null").join(base.select("key", "v"), "v").select("query_id", "key").distinct(), "ann-queries")
    asked = materialize(base.join(queries.select("key").distinct(), "key", "left_semi").select("key", "v"), "ann-asked")

    unit = float(base.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0])
    drawn = base.select("key", "v").orderBy(F.xxhash64("key")).limit(sample).select("v").toPandas()["v"]  # a bounded sample
    aims, norms = _directions(np.stack(drawn.map(np.asarray)), unit)
    index = Index(aims.astype(np.float32), norms, max(1, min(sample // PER_LIST, round(n**0.5))))
    if asked.isEmpty():
        return spark.createDataFrame([], RESULT)
    probes = len(index.centroids) if exact else _calibrate(base, asked, index, k, unit)
    directions = lambda x: _directions(_vectors(x, dim), unit)

    def encode(batches):
        for batch in slices(batches, 4096):
            aims, norms = directions(batch.column("v"))
            near, codes, missed, angle = index.encode(aims)
            packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(codes.shape[1]), len(codes), [None, pa.py_buffer(np.ascontiguousarray(codes))])
            columns = [batch.column("key"), batch.column("v"), pa.array(near, pa.int32()), packed.cast(pa.binary()), pa.array(norms), pa.array(missed), pa.array(angle)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "v", "list", "codes", "norm", "missed", "angle"])

    coded = materialize(base.select("key", "v").mapInArrow(encode, f"key long, v {kind}, list int, codes binary, norm double, missed double, angle double"), "ann-index")
    told = coded.groupBy("list").agg(F.count("*").alias("n"), F.max("angle"), F.min("norm"), F.max("norm")).collect()  # a row a list
    shards, lists = _shards({r["list"]: r["n"] for r in told}), len(index.centroids)
    held_by, angles, least, most = np.zeros(lists, np.int64), np.zeros(lists), np.zeros(lists), np.zeros(lists)
    for number, *row in told:
        held_by[number], angles[number], least[number], most[number] = row
    of_list = spark.createDataFrame([(a, b) for a, b in shards.items()], "list int, shards array<int>")
    placed = coded.join(F.broadcast(of_list), "list").withColumn("shard", F.get("shards", F.pmod(F.xxhash64("key"), F.size("shards")).cast("int")))

    def visit(batches):
        """Visits of the nearest lists, where nothing is known yet, and else of the others that may hold as good a row."""
        for batch in slices(batches, 512):
            out = []
            q, norms = directions(batch.column("v"))
            near, limits = visited(index, q, held_by, probes, k + 1), index.limits(q, angles, least, most)
            for i, (key, v, score) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("key", "v", "score")), strict=True)):
                floor, numbers = float("-inf"), near[i]
                if score is not None:
                    floor = score / (norms[i] * unit) / unit if 0 < norms[i] * unit < np.inf else floor
                    numbers = np.setdiff1d(np.flatnonzero(limits[i] >= floor - 1e-12 * most), numbers).tolist()
                by_shard: dict[int, list[int]] = {}
                for number in numbers:
                    for shard in shards.get(number, ()):
                        by_shard.setdefault(shard, []).append(number)
                out += [(key, v, floor, shard, of) for shard, of in by_shard.items()]
            columns = list(zip(*out, strict=True)) or [[], [], [], [], []]
            types = (pa.int64(), batch.schema.field("v").type, pa.float64(), pa.int32(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["key", "v", "floor", "shard", "lists"])

    rounding = 2.4e-7 * (dim + 32)  # of estimates in single precision

    def scan(asks: pa.Table, held: pa.Table) -> pa.Table:
        out = [[], [], []]
        if asks.num_rows and held.num_rows:
            held = held.sort_by("list").combine_chunks()
            asks = asks.combine_chunks()
            vectors, keys, lists = _vectors(held.column("v").chunk(0), dim), held.column("key").to_numpy(), held.column("list").to_numpy()
            aims, norms, missed = directions(held.column("v").chunk(0))[0], held.column("norm").to_numpy(), held.column("missed").to_numpy() + rounding
            codes = np.frombuffer(b"".join(held.column("codes").to_pylist()), np.uint8).reshape(len(keys), -1)
            starts = np.flatnonzero(np.r_[True, lists[1:] != lists[:-1]])
            slices = {int(lists[a]): (int(a), int(b)) for a, b in zip(starts, np.r_[starts[1:], len(lists)], strict=True)}
            q_all, q_keys, q_lists, floors = _vectors(asks.column("v").chunk(0), dim), asks.column("key").to_numpy(), asks.column("lists").to_pylist(), asks.column("floor").to_numpy()
            q_aims = directions(asks.column("v").chunk(0))[0]
            for at in range(0, len(q_keys), 256):
                q, aim = q_all[at : at + 256], q_aims[at : at + 256]
                near = aim.astype(np.float32)
                tables, coarse = index.tables(near), near @ index.centroids.T
                scores = np.full((len(q), len(keys)), -np.inf, np.float32)
                visitors: dict[int, list[int]] = {}
                for i, of in enumerate(q_lists[at : at + 256]):
                    for number in of:
                        visitors.setdefault(number, []).append(i)
                for number, who in visitors.items():
                    if number in slices:
                        a, b = slices[number]
                        estimate = np.zeros((len(who), b - a), np.float32)
                        for part, table in enumerate(tables):
                            estimate += table[who][:, codes[a:b, part]]
                        scores[np.asarray(who), a:b] = coarse[who, number][:, None] + index.scale[number] * estimate
                likely, depth = scores * norms, min(RERANK, len(keys))
                best = np.argpartition(-likely, depth - 1, axis=1)[:, :depth]
                wanted = np.zeros(scores.shape, bool)
                for i in range(len(q)):
                    mine = best[i][scores[i][best[i]] > -np.inf]
                    known, floor = np.sort(aims[mine] @ aim[i] * norms[mine]), floors[at + i]
                    floor = max(floor, known[-k - 1]) if len(known) > k else floor
                    wanted[i] = (scores[i] > -np.inf) & (exact | ((scores[i] + missed) * norms >= floor - 1e-12 * norms))
                    wanted[i, mine] = True
                some = np.flatnonzero(wanted.any(0))
                close = aim @ aims[some].T * norms[some]
                for i in range(len(q)):
                    here = np.flatnonzero(wanted[i, some])
                    score, mine = close[i, here], some[here]
                    if len(score) > k + 1:  # those that rounding may exchange are told apart by their exact scores
                        mine = mine[score + 1e-12 * norms[mine] >= np.partition(score, -k - 1)[-k - 1]]
                    found = exact_scores(vectors[mine], q[i][None, :])
                    top = _top(found, keys[mine], k + 1)
                    out[0].append(np.full(len(top), q_keys[at + i]))
                    out[1].append(keys[mine[top]])
                    out[2].append(found[top])
        flat = [np.concatenate(x) if x else np.zeros(0) for x in out]
        return pa.table({"key": pa.array(flat[0], pa.int64()), "found": pa.array(flat[1], pa.int64()), "score": pa.array(flat[2], pa.float64())})

    def scanned(asks: DataFrame) -> DataFrame:
        visits = materialize(asks.mapInArrow(visit, f"key long, v {kind}, floor double, shard int, lists array<int>"), "ann-visits")
        blocks = visits.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
        left = visits.join(F.broadcast(blocks), "shard").withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int"))  # a row a shard
        right = placed.join(F.broadcast(blocks), "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        pairs = left.select("shard", "block", "key", "v", "floor", "lists").groupBy("shard", "block").cogroup(
            right.select("shard", "block", "key", "v", "list", "codes", "norm", "missed").groupBy("shard", "block")
        )
        return materialize(pairs.applyInArrow(scan, "key long, found long, score double"), "ann-found")

    found = scanned(asked.withColumn("score", F.lit(None).cast("double")))
    if probes < lists:  # what is known now bounds what the other lists must offer
        falling = Window.partitionBy("key").orderBy(F.desc("score"), "found")
        last = found.withColumn("at", F.row_number().over(falling)).where(F.col("at") <= k + 1).groupBy("key").agg(F.when(F.count("*") > k, F.min("score")).otherwise(float("-inf")).alias("score"))
        found = found.union(scanned(asked.join(last, "key").select("key", "v", "score")))
    best = Window.partitionBy("key").orderBy(F.desc("score"), "found")
    near = found.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k + 1).drop("at")
    spread = near.join(base.select(F.col("key").alias("found"), "ids"), "found").select("key", "score", F.explode("ids").alias("vec_id"))
    by_id = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    answers = spread.withColumn("at", F.row_number().over(by_id)).where(F.col("at") <= k + 1).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("at", "vec_id", "score"))).alias("list"))
    # One row a query vector, so a vector with many query ids joins many rows to one and is split where it is hot.
    others = F.filter("list", lambda x: x["vec_id"] != F.col("query_id"))
    numbered = queries.join(answers, "key").select("query_id", F.posexplode(F.slice(others, 1, k)).alias("pos", "hit"))
    return numbered.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
