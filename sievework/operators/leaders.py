"""Greedy leaders among the vectors of a block, without a list of the similar pairs.

The pairs grow with the square of a block's rows, the leaders hardly do.
Each round the best rows that are still open find the leaders among
themselves, which is exact as every better row is settled; then the open
rows meet the new leaders, and those that are similar to one are settled.
At the end all rows meet all leaders to tell which one they join.

A cosine is summed in one order whatever rows it is computed with, so the
rounds and the end agree on every pair.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework.operators import rank
from sievework.plans.shared import materialize

#: Open rows of a block that look for leaders in the first round, and at most; the number doubles, so rounds stay few where most rows lead.
FIRST, MOST = 1024, 8192
#: Rows of a block that meet leaders in one group, and leaders that they meet there at the end.
SLOT, LEADERS = 4096, 2048
#: Rows that are compared at a time, and cosines that are held at a time.
STEP, CELLS = 256, 1 << 18

#: The order of the rows, from the best: by score, NaN above all, then by hash and id.
ORDER = ["_nan", "_score", "_hash", "id"]


def _matrix(rows: pa.Table) -> np.ndarray:
    """The vectors of rows of one length."""
    return rows["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)


def _places(rows: pa.Table) -> np.ndarray:
    """The rows in ``ORDER``."""
    return pc.sort_indices(rows, sort_keys=[(k, "descending") for k in ORDER]).to_numpy()


def _length(x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x))
    for k in range(x.shape[1]):
        out += x[:, k] * x[:, k]
    return np.sqrt(out)


def _cosines(x: np.ndarray, y: np.ndarray):
    """(start, cosines) of slices of ``x`` with all of ``y``."""
    lengths, turned = _length(y), np.ascontiguousarray(y.T)
    step = max(1, min(STEP, CELLS // max(len(y), 1)))
    for start in range(0, len(x), step):
        part = x[start : start + step]
        out = np.zeros((len(part), len(y)))
        with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
            for k in range(x.shape[1]):
                out += np.multiply.outer(part[:, k], turned[k])
            yield start, out / np.multiply.outer(_length(part), lengths)


def _near(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of ``x`` are similar to one of ``y``; NaN counts as large."""
    out = np.zeros(len(x), dtype=bool)
    for start, cosine in _cosines(x, y):
        out[start : start + len(cosine)] = (~(cosine < threshold)).any(axis=1)
    return out


def _lead(threshold: float) -> Callable[[pa.Table], pa.Table]:
    """The leaders among the best open rows of a block."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.take(pa.array(_places(rows)))
        x, leaders = _matrix(rows), []
        for start in range(0, len(x), STEP):
            part = x[start : start + STEP]
            led = _near(part, x[leaders], threshold)
            near = np.concatenate([~(c < threshold) for _, c in _cosines(part, part)])
            for i in range(len(part)):
                if not led[i]:
                    leaders.append(start + i)
                    led |= near[i]
        return rows.take(pa.array(leaders, pa.int64()))

    return run


def _settle(threshold: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The open rows that are neither new leaders nor similar to one."""

    def run(rows: pa.Table, leaders: pa.Table) -> pa.Table:
        if not len(rows) or not len(leaders):
            return rows
        settled = _near(_matrix(rows), _matrix(leaders), threshold) | pc.is_in(rows["id"], pc.unique(leaders["id"])).to_numpy()
        return rows.filter(pa.array(~settled))

    return run


def _join(rows: pa.Table, leaders: pa.Table) -> pa.Table:
    """The best leader of each row among these: itself, or the most similar one before it, of equals the better."""
    order = _places(pa.concat_tables([t.select(ORDER) for t in (rows, leaders)]))
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    mine = pc.is_in(rows["id"], pc.unique(leaders["id"])).to_numpy()
    sorted_ = np.argsort(place[len(rows) :])
    leaders, theirs, place = leaders.take(pa.array(sorted_)), place[len(rows) :][sorted_], place[: len(rows)]
    best, similarity = np.full(len(rows), -1), np.zeros(len(rows))
    if len(rows) and len(leaders):
        for start, cosine in _cosines(_matrix(rows), _matrix(leaders)):
            at = slice(start, start + len(cosine))
            before = theirs[None, :] < place[at, None]
            top = np.where(before, np.where(np.isnan(cosine), np.inf, cosine), -np.inf).argmax(axis=1)  # the first of equals is the better leader
            similarity[at] = cosine[np.arange(len(cosine)), top]
            best[at] = np.where(before.any(axis=1), top, -1)
    found = np.flatnonzero(mine | (best >= 0))
    chosen = leaders.take(pa.array(np.maximum(best[found], 0)))
    own, ids = pa.array(mine[found]), rows["id"].take(pa.array(found))
    cluster = pc.if_else(own, ids, chosen["id"])
    return pa.table({"id": ids, "cluster": cluster, "own": own, "similarity": similarity[found], **{k: chosen[k] for k in ORDER[:3]}})


def vector_leaders(vectors: DataFrame, block: list[str], threshold: float) -> DataFrame:
    """(id, cluster) of rows (id, v, score, *block): what ``rank.leader_clusters`` makes of ``rank.similar_pairs``.

    Work grows with the rows times the leaders of a block, what is shuffled
    and written with the rows.  Rows without block, vector or length lead
    themselves.
    """
    score = F.coalesce(F.col("score").cast("double"), F.lit(float("-inf")))
    order = {"_nan": F.isnan(score), "_score": F.when(F.isnan(score), 0.0).otherwise(score), "_hash": F.bitwise_not(F.hash("id"))}
    usable = F.coalesce(rank.comparable(block), F.lit(False))
    keys = [*block, "_size"]
    unit = materialize(vectors.where(usable).select(*block, F.size("v").alias("_size"), "id", "v", *[c.alias(n) for n, c in order.items()]), "leader-vectors")
    sizes = materialize(unit.groupBy(*keys).agg(F.ceil(F.count("*") / SLOT).cast("int").alias("_slots")), "leader-blocks")
    small = F.broadcast if sizes.count() <= rank.BROADCAST_BLOCKS else lambda table: table  # a row a block
    place, best_first = F.struct(*ORDER), Window.partitionBy(*keys).orderBy(*[F.desc(k) for k in ORDER])
    open_, found, most = unit, [], FIRST
    while True:
        best = open_.select(*keys, *ORDER).withColumn("_n", F.row_number().over(best_first)).where(F.col("_n") <= most)
        cuts = materialize(best.groupBy(*keys).agg(F.min(place).alias("_cut")), "leader-cuts")
        tried = open_.join(small(cuts), keys).where(place >= F.col("_cut")).select(*unit.columns)
        found.append(materialize(tried.groupBy(*keys).applyInArrow(_lead(threshold), unit.schema), "leader-found"))
        spread = found[-1].join(small(sizes), keys).withColumn("_slot", F.explode(F.sequence(F.lit(0), F.col("_slots") - 1))).select(*unit.columns, "_slot")
        dealt = open_.join(small(sizes), keys).withColumn("_slot", F.pmod(F.xxhash64("id"), F.col("_slots")).cast("int")).select(*unit.columns, "_slot")
        rest = dealt.groupBy(*keys, "_slot").cogroup(spread.groupBy(*keys, "_slot")).applyInArrow(_settle(threshold), dealt.schema)
        open_, most = materialize(rest.select(*unit.columns), "leader-open"), min(2 * most, MOST)
        if open_.isEmpty():
            break
    leaders = found[0]
    for more in found[1:]:
        leaders = leaders.union(more)
    tiles = materialize(leaders.groupBy(*keys).agg(F.ceil(F.count("*") / LEADERS).cast("int").alias("_tiles")), "leader-tiles")
    both = materialize(sizes.join(small(tiles), keys), "leader-deal")
    group = [*keys, "_slot", "_tile"]
    tile = lambda count: F.pmod(F.xxhash64("id"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    rows = unit.join(small(both), keys).withColumn("_slot", tile("_slots")).withColumn("_tile", every("_tiles")).select(*unit.columns, "_slot", "_tile")
    heads = leaders.join(small(both), keys).withColumn("_tile", tile("_tiles")).withColumn("_slot", every("_slots")).select(*unit.columns, "_slot", "_tile")
    kind = vectors.schema["id"].dataType.simpleString()
    met = rows.groupBy(*group).cogroup(heads.groupBy(*group)).applyInArrow(_join, f"id {kind}, cluster {kind}, own boolean, similarity double, _nan boolean, _score double, _hash int")
    joined = met.groupBy("id").agg(F.max_by("cluster", F.struct("own", "similarity", *ORDER[:3], "cluster")).alias("cluster"))
    alone = vectors.where(~usable).select("id", F.col("id").alias("cluster"))
    return materialize(joined.union(alone), "leader-clusters")
