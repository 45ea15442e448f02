"""Ranking: score, cluster, quota; and the refinement loop."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework.functions import metrics, sequences, stats
from sievework.operators import gates
from sievework.plans.shared import materialize

# Weights of the final score.
WEIGHTS = {"i_pTM_mean": 0.30, "i_PAE_mean_inv": 0.20, "pLDDT_binder": 0.15, "buried_sasa_norm": 0.15, "boltz2_affinity_prob": 0.10, "predictors_agreeing": 0.10}

#: Rows of a tile in the comparison of all pairs of a block.
TILE = 512
#: Blocks up to which the table of their sizes is broadcast; a shuffled join beyond.
BROADCAST_BLOCKS = 50_000


def final_score(lowered: Column, agreeing: Column, predictors: int = 4, sasa_full: float = 1500.0) -> Column:
    """Weighted sum of terms between 0 and 1; a missing term is 0.

    The reciprocal of PAE is 1 / (1 + PAE), pLDDT is a percentage, buried
    area counts up to ``sasa_full`` and agreement up to ``predictors``.
    These normalisations are ours.
    """
    get = lambda *names: F.coalesce(*[metrics.value_of(lowered, n.lower()) for n in names])
    terms = {
        "i_pTM_mean": F.coalesce(get("i_pTM_mean"), metrics.resolve(lowered, "i_pTM")),
        "i_PAE_mean_inv": 1 / (1 + F.coalesce(get("i_PAE_mean"), metrics.resolve(lowered, "i_PAE"))),
        "pLDDT_binder": metrics.resolve(lowered, "pLDDT_binder") / 100,
        "buried_sasa_norm": F.least(metrics.resolve(lowered, "buried_sasa_A2") / sasa_full, F.lit(1.0)),
        "boltz2_affinity_prob": metrics.resolve(lowered, "boltz2_affinity_prob"),
        "predictors_agreeing": F.least(agreeing / predictors, F.lit(1.0)),
    }
    return sum((F.lit(w) * F.coalesce(F.nanvl(terms[k].cast("double"), F.lit(0.0)), F.lit(0.0)) for k, w in WEIGHTS.items()), F.lit(0.0))


def with_selectivity(score: Column, lowered: Column, target: dict) -> Column:
    """The score, of which a target's ``selectivity_score`` gives a share to the metric ``srs``, between 0 and 1; a missing one is 0."""
    rule = target.get("selectivity_score") or {}
    if not rule.get("enabled") or not (weight := float(rule.get("weight_in_final") or 0)):
        return score
    srs = F.coalesce(F.nanvl(metrics.value_of(lowered, "srs").cast("double"), F.lit(0.0)), F.lit(0.0))
    return score * (1 - weight) + F.greatest(F.least(srs, F.lit(1.0)), F.lit(0.0)) * weight


def missing_terms(lowered: Column, agreeing: Column) -> Column:
    """Names of the score's terms that a record doesn't have."""
    has = {k: metrics.resolve(lowered, n).isNotNull() for k, n in (("i_pTM_mean", "i_pTM"), ("i_PAE_mean_inv", "i_PAE"), ("pLDDT_binder", "pLDDT_binder"), ("buried_sasa_norm", "buried_sasa_A2"), ("boltz2_affinity_prob", "boltz2_affinity_prob"))}
    return F.array_compact(F.array(*[F.when(~v, F.lit(k)) for k, v in has.items()], F.when(agreeing.isNull(), F.lit("predictors_agreeing"))))


def leader_clusters(pairs: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """(id, cluster): greedy leader clustering of ``items`` (id, score) by similarity ``pairs`` (a, b, similarity), both ways or one.

    By falling score, an item joins the best earlier leader that is similar
    enough, or becomes one.  Each round makes leaders of the items all whose
    better neighbours are followers, and followers of those that have a
    leader among them; which leader they join is told at the end.  Rounds
    grow with the logarithm of the items, if scores aren't ordered along
    the neighbours; nothing is collected.
    """
    order = lambda s, i: F.struct(F.coalesce(s, F.lit(float("-inf"))).alias("s"), (F.lit(0) - F.hash(i)).alias("h"), i.alias("i"))
    both = pairs.select("a", "b", "similarity").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity")).where((F.col("similarity") >= threshold) & (F.col("a") != F.col("b")))
    ranked = items.select("id", order(F.col("score"), F.col("id")).alias("k"))
    better = both.join(ranked.select(F.col("id").alias("a"), F.col("k").alias("ka")), "a").join(ranked.select(F.col("id").alias("b"), F.col("k").alias("kb")), "b").where("kb > ka")
    better = materialize(better.groupBy("a", "b", "kb").agg(F.max("similarity").alias("similarity")), "leader-better")  # b may lead a
    state = materialize(ranked.select("id", F.lit(None).cast("boolean").alias("leads")), "leader-state")
    left = better.select("a", "b")
    while True:
        open_ = state.where("leads is null").select(F.col("id").alias("a"))
        left = materialize(left.join(open_, "a", "left_semi"), "leader-left")  # settled items need no pairs any more
        known = left.join(state.select(F.col("id").alias("b"), "leads"), "b")
        seen = known.groupBy("a").agg(F.max(F.coalesce("leads", F.lit(False))).alias("led"), F.max(F.col("leads").isNull()).alias("waits"))
        told = F.when(F.col("led"), False).when(F.coalesce("waits", F.lit(False)), None).otherwise(True)
        state = materialize(state.join(seen, state["id"] == seen["a"], "left").select("id", F.coalesce("leads", told).alias("leads")), "leader-state")
        if state.where("leads is null").isEmpty():
            break
    leaders = state.where("leads").select(F.col("id").alias("b"))
    joined = better.join(leaders, "b", "left_semi").groupBy("a").agg(F.max_by("b", F.struct("similarity", "kb")).alias("leader"))
    followers = joined.join(state.where("not leads").select(F.col("id").alias("a")), "a", "left_semi").select(F.col("a").alias("id"), F.col("leader").alias("cluster"))
    return materialize(leaders.select(F.col("b").alias("id"), F.col("b").alias("cluster")).union(followers), "leader-clusters")


def _forest(i: np.ndarray, j: np.ndarray, similarity: np.ndarray) -> np.ndarray:
    """Which edges a spanning forest of the greatest similarities keeps: at every cut they connect what all edges connect; NaN counts as large."""
    order = np.argsort(-np.where(np.isnan(similarity), np.inf, similarity), kind="stable")
    root, kept = list(range(int(max(i.max(), j.max())) + 1 if len(i) else 0)), []
    most = len(np.unique(np.r_[i, j])) - 1
    for k, a, b in zip(order.tolist(), i[order].tolist(), j[order].tolist(), strict=True):
        while root[a] != a:
            root[a] = a = root[root[a]]
        while root[b] != b:
            root[b] = b = root[root[b]]
        if a != b:
            root[a] = b
            kept.append(k)
            if len(kept) == most:
                break
    return np.array(kept, dtype=np.int64)


def _meet(threshold: float, forest: bool) -> Callable[[pa.Table], pa.Table]:
    """The similar pairs between two tiles, or within one if ``lo`` and ``hi`` are equal; or a spanning forest of them."""

    def run(rows: pa.Table) -> pa.Table:
        vectors = rows["v"].combine_chunks()
        tile, lo, hi = (rows[k].to_numpy() for k in ("tile", "lo", "hi"))
        ends = vectors.offsets.to_numpy()
        sizes, values = np.diff(ends), vectors.values.to_numpy(zero_copy_only=False)
        found = []
        for size in np.unique(sizes):  # vectors of different lengths have no cosine
            at = lambda which: np.flatnonzero((sizes == size) & (tile == which[0]))  # noqa: B023, E731
            left, right = at(lo), at(hi)
            x, y = (values[ends[i][:, None] + np.arange(size)].astype(np.float64) for i in (left, right))
            with np.errstate(invalid="ignore"):
                cosine = (x @ y.T) / np.outer(np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1)))
                near = ~(cosine < threshold)  # NaN counts as large, as in SQL
            i, j = np.nonzero(np.triu(near, 1) if lo[0] == hi[0] else near)
            found.append((left[i], right[j], cosine[i, j]))
        i, j, cosine = (np.concatenate(x) for x in zip(*found, strict=True))
        if forest:
            kept = _forest(i, j, cosine)
            i, j, cosine = i[kept], j[kept], cosine[kept]
        return pa.table({"a": rows["id"].take(pa.array(i)), "b": rows["id"].take(pa.array(j)), "similarity": cosine})

    return run


def comparable(block: list[str]) -> Column:
    """Whether a row (id, v, *block) has a name, a block and a vector with a length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, z: s + z)
    named = reduce(Column.__and__, [F.col(k).isNotNull() for k in block], F.col("id").isNotNull())
    return named & (dot(F.col("v"), F.col("v")) > 0)


def similar_pairs(vectors: DataFrame, block: list[str], threshold: float, forest: bool = False) -> DataFrame:
    """(a, b, similarity) of the pairs within a block whose cosine reaches ``threshold``; rows (id, v, *block).

    All pairs of a block are compared.  A block of any size is dealt by id
    into tiles of about ``TILE`` rows, and each two tiles meet in a group
    of their own, so that no task holds more than two tiles at once.  With
    ``forest`` a group tells only the pairs of a spanning forest of its own,
    fewer than it has rows, which connect the same rows at every cut: all
    that single linkage needs.
    """
    unit = vectors.select("id", "v", *block).where(comparable(block))
    sizes = materialize(unit.groupBy(*block).agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")), "pair-blocks")
    dealt = unit.join(F.broadcast(sizes) if sizes.count() <= BROADCAST_BLOCKS else sizes, block).withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumns({"lo": F.least("tile", "other"), "hi": F.greatest("tile", "other")})
    kind = vectors.schema["id"].dataType.simpleString()
    pairs = met.select(*block, "id", "v", "tile", "lo", "hi").groupBy(*block, "lo", "hi").applyInArrow(_meet(threshold, forest), f"a {kind}, b {kind}, similarity double")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity").where("a < b")


def number_clusters(clusters: DataFrame) -> DataFrame:
    """(id, cluster_id) of rows (id, cluster): clusters numbered from 1 in the order of their leaders."""
    leaders = clusters.select("cluster").distinct().withColumn("one", F.lit(1).cast("long"))
    numbers = stats.cumulate(leaders, F.col("cluster").asc(), {"number": "one"}).select("cluster", F.col("number").cast("int").alias("cluster_id"))
    return clusters.join(numbers, "cluster").select("id", "cluster_id")


def round_robin(designs: DataFrame, quota: int, id_col="design_id", cluster_col="cluster_id", score_col="final_score", reserve: float = 0.0) -> DataFrame:
    """``quota`` rows, in rounds that take the next best of every cluster; ``turn`` is the round.

    A share ``reserve`` of the places goes to the best row of the worst
    scored clusters that the rounds leave out.
    """
    best = Window.partitionBy(cluster_col).orderBy(F.desc_nulls_last(score_col), id_col)
    turns = designs.withColumn("turn", F.row_number().over(best))
    kept = quota - int(quota * reserve)
    main = turns.where(F.col("turn") <= quota).orderBy("turn", F.desc_nulls_last(score_col), id_col).limit(kept)
    if kept == quota:
        return main
    main = materialize(main, "quota-main")
    rest = turns.where("turn = 1").join(main.select(cluster_col).distinct(), cluster_col, "left_anti").orderBy(F.asc_nulls_first(score_col), id_col).limit(quota - kept)
    rest = materialize(rest.select(*main.columns), "quota-rest")
    short = quota - kept - rest.count()
    more = turns.join(main.select(id_col), id_col, "left_anti").join(rest.select(id_col), id_col, "left_anti").orderBy("turn", F.desc_nulls_last(score_col), id_col).limit(short)
    return main.unionByName(rest).unionByName(more.select(*main.columns))


def filter_stage(designs: DataFrame, profile: dict) -> DataFrame:
    """Set passed_screen, passed_select and liability_flags (with those of the profile's gates) of decoded designs."""
    low, agree = F.col("_low"), F.col("predictors_agreeing")
    held, values = metrics.bind(designs.withColumn("_low", metrics.lower_keys(F.col("metrics"))), low, profile)
    return held.withColumns(
        {
            "passed_screen": metrics.passes_level(values, agree, profile, "screen"),
            "passed_select": metrics.passes_level(values, agree, profile, "select"),
            "liability_flags": F.concat(sequences.liability_flags(F.col("sequence"), profile), gates.flags(F.col("sequence"), low, profile)),
        }
    ).drop("_low", "_bound")


def apportion(total: int, shares: dict[str, float]) -> dict[str, int]:
    """Whole numbers by share that add up to ``total``: the largest remainders get what is left."""
    whole = sum(shares.values()) or 1.0
    exact = {k: total * v / whole for k, v in shares.items()}
    out = {k: int(v) for k, v in exact.items()}
    for k in sorted(exact, key=lambda k: (out[k] - exact[k], k))[: total - sum(out.values())]:
        out[k] += 1
    return out
