"""Contacts between atoms: a range join on a grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def contacts(left: DataFrame, right: DataFrame, within: float = 3.5, keys: tuple[str, ...] = ("structure",)) -> DataFrame:
    """(keys, a, b, distance) of atoms (keys, atom, x, y, z) no farther apart than ``within``.

    Space is cut into cubes of that size.  A left atom is met with the right
    atoms of its own and the 26 neighbouring cubes, so only near atoms of
    one structure ever meet; with hydrogen-bond donors and acceptors and
    3.5 this counts bonds by distance.
    """
    cell = lambda c: F.floor(F.col(c) / within)
    steps = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    a = left.select(*keys, F.col("atom").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("z").alias("az"), *[cell(c).alias(f"c{c}") for c in "xyz"])
    for c in "xyz":
        a = a.withColumn("_s", F.explode(steps)).withColumn(f"c{c}", F.col(f"c{c}") + F.col("_s")).drop("_s")
    b = right.select(*keys, F.col("atom").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"), F.col("z").alias("bz"), *[cell(c).alias(f"c{c}") for c in "xyz"])
    far = F.sqrt(sum(((F.col(f"a{c}") - F.col(f"b{c}")) ** 2 for c in "xyz"), F.lit(0.0)))
    return a.join(b, [*keys, "cx", "cy", "cz"]).withColumn("distance", far).where(F.col("distance") <= within).select(*keys, "a", "b", "distance")


def count_contacts(pairs: DataFrame, keys: tuple[str, ...] = ("structure",)) -> DataFrame:
    """Contacts of each structure."""
    return pairs.groupBy(*keys).agg(F.count("*").alias("contacts"))
