"""Connected components by alternating large and small stars.

Every round links each node's larger neighbours to the smallest node it
knows, then does the same with its smaller neighbours; the edges end as
stars around the smallest node of each component (Kiveris et al., 2014).
Rounds grow with the logarithm of the longest path.  Only sums and
distinct edges are shuffled; no neighbourhood is collected, so a node with
millions of neighbours costs what its edges cost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.plans.shared import materialize


def _smallest(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest node among u and its neighbours."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node of its component."""
    stars = materialize(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "cc-edges"
    )
    state = None
    while True:
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_smallest(both), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        small = large.join(_smallest(large), "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        stars = materialize(small.where(F.col("u") != F.col("v")).distinct(), "cc-stars")
        now = stars.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state == now:
            break
        state = now
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
