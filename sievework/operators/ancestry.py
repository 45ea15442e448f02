"""Roots and depths of parent pointers by pointer jumping.

Each round every open row takes over what its present ancestor knows, which
doubles the distance: a chain of n rows ends in log2(n) rounds.  A round in
which no row ends shows that all open ones lead into cycles, since of open
rows with a root the nearest always end in the next round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.plans.shared import materialize

ROOT, ORPHAN, CYCLE = "root", "orphan", "cycle"


def ancestry(nodes: DataFrame, id_col: str = "design_id", parent_col: str = "parent_id") -> DataFrame:
    """(id, root, depth, ends): where each row's chain of parents ends, and after how many steps.

    ``ends`` is ``root`` (a row without parent), ``orphan`` (a row whose
    parent isn't there; it counts as the root) or ``cycle`` (root and depth
    are null then).  Of rows that repeat an id the one with the smallest
    parent counts, nulls last; rows without an id are left out.
    """
    pairs = nodes.select(F.col(id_col).alias("id"), F.col(parent_col).alias("parent")).where("id is not null").groupBy("id").agg(F.min("parent").alias("parent"))
    pairs = materialize(pairs, "ancestry-pairs")
    there = pairs.select(F.col("id").alias("parent"), F.lit(True).alias("there"))
    ends = F.when(F.col("parent").isNull(), ROOT).when(F.col("there").isNull(), ORPHAN)
    first = pairs.join(there, "parent", "left").withColumn("ends", ends)
    state = first.select("id", F.when(F.col("ends").isNull(), F.col("parent")).otherwise(F.col("id")).alias("up"), F.when(F.col("ends").isNull(), 1).otherwise(0).cast("long").alias("depth"), "ends")
    left = None
    while True:
        state = materialize(state, "ancestry")
        before, left = left, state.where("ends is null").count()
        if left in (0, before):
            break
        known = state.select(F.col("id").alias("up"), F.col("up").alias("far"), F.col("depth").alias("more"), F.col("ends").alias("told"))
        moved = state.where("ends is null").join(known, "up").select("id", F.col("far").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), F.col("told").alias("ends"))
        state = state.where("ends is not null").unionByName(moved)
    ended = F.col("ends").isNotNull()
    return state.select("id", F.when(ended, F.col("up")).alias("root"), F.when(ended, F.col("depth")).alias("depth"), F.coalesce("ends", F.lit(CYCLE)).alias("ends"))
