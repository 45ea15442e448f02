"""Hierarchical clusters by single linkage: a spanning forest by Borůvka rounds, and cuts of its dendrogram.

A round lets every component choose the best edge that leaves it, by
similarity and then by ids, so the choices never close a ring but in pairs
of components that choose the same edge.  Each component points to the one
it chose, the smaller of such a pair is a root, and pointers are jumped to
the roots.  Components at least halve, edges inside one are dropped and of
those between two only the best stays: rounds grow with the logarithm of the
items, and tables shrink with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.operators.ancestry import ancestry
from sievework.plans.shared import materialize


def _better() -> Column:
    """A key that is least for the best edge; equal keys are the same edge."""
    return F.struct((-F.col("similarity")).alias("far"), "a", "b")


def _contract(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((id, root) of the items that have an edge, chosen edges (a, b, similarity)) of edges (a, b, similarity)."""
    fine = pairs.where("a is not null and b is not null and a <> b and similarity is not null")
    once = fine.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("similarity").cast("double").alias("similarity"))
    edges = materialize(once.select("a", "b", "similarity", F.col("a").alias("ca"), F.col("b").alias("cb")), "forest-edges")
    items = edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).distinct()
    labels, chosen = materialize(items.withColumn("root", F.col("id")), "forest-labels"), None
    while not edges.isEmpty():
        sides = edges.select(F.col("ca").alias("c"), F.col("cb").alias("to"), _better().alias("e")).union(edges.select(F.col("cb"), F.col("ca"), _better()))
        best = materialize(sides.groupBy("c").agg(F.min(F.struct("e", "to")).alias("m")).select("c", "m.to", "m.e"), "forest-best")
        new = best.select("e.a", "e.b", (-F.col("e.far")).alias("similarity")).distinct()
        chosen = materialize(new if chosen is None else chosen.union(new), "forest-chosen")
        back = best.select(F.col("c").alias("to"), F.col("to").alias("back"))
        mutual = (F.col("back") == F.col("c")) & (F.col("c") < F.col("to"))
        pointers = best.join(back, "to").select(F.col("c").alias("id"), F.when(~mutual, F.col("to")).alias("parent"))
        roots = materialize(ancestry(pointers, "id", "parent").select(F.col("id").alias("c"), F.col("root").alias("r")), "forest-roots")
        labels = materialize(labels.join(roots, labels["root"] == roots["c"], "left").select("id", F.coalesce("r", "root").alias("root")), "forest-labels")
        moved = edges.join(roots.select(F.col("c").alias("ca"), F.col("r").alias("ra")), "ca").join(roots.select(F.col("c").alias("cb"), F.col("r").alias("rb")), "cb").where("ra <> rb")
        merged = moved.groupBy(F.least("ra", "rb").alias("ca"), F.greatest("ra", "rb").alias("cb")).agg(F.min(_better()).alias("e"))
        edges = materialize(merged.select("e.a", "e.b", (-F.col("e.far")).alias("similarity"), "ca", "cb"), "forest-edges")
    return labels, chosen if chosen is not None else edges.select("a", "b", "similarity")


def spanning_forest(pairs: DataFrame) -> DataFrame:
    """(a, b, similarity): the edges by which single linkage merges; pairs (a, b, similarity) may come both ways or repeated."""
    return _contract(pairs)[1]


def cut(forest: DataFrame, items: DataFrame, cuts: list[float]) -> DataFrame:
    """(id, cut, cluster): clusters of ``items`` (id) at each similarity of ``cuts``, named by their smallest id.

    All cuts are made at once; an item without an edge is a cluster of its own.
    """
    levels = F.explode(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: F.col("similarity") >= c))
    at = lambda c: F.struct("cut", F.col(c).alias("id"))
    labels, _ = _contract(forest.withColumn("cut", levels).select(at("a").alias("a"), at("b").alias("b"), "similarity"))
    told = materialize(labels.select("id.cut", "id.id", F.col("root.id").alias("root")), "forest-cut")
    named = told.join(told.groupBy("cut", "root").agg(F.min("id").alias("cluster")), ["cut", "root"]).select("cut", "id", "cluster")
    every = items.select("id").distinct().withColumn("cut", F.explode(F.array(*[F.lit(float(c)) for c in cuts])))
    return every.join(named, ["cut", "id"], "left").select("id", "cut", F.coalesce("cluster", "id").alias("cluster"))


def single_linkage(pairs: DataFrame, items: DataFrame, cuts: list[float]) -> DataFrame:
    """``cut`` of the spanning forest of ``pairs``."""
    return cut(spanning_forest(pairs), items, cuts)
