"""Calibration statistics: AUC, ROC curve, medians, enrichment, histogram, description.

Ranks and cumulative counts over a whole table would put it into one task.
Here rows are first summed by score value, values are dealt to range
partitions, and only the partitions' totals meet.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework.plans.shared import materialize


def cumulate(counts: DataFrame, order: Column, sums: dict[str, str]) -> DataFrame:
    """Add running sums ``new: old`` in ``order`` (a unique sort key), each row included."""
    parted = materialize(counts.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "running")
    totals = parted.groupBy("_part").agg(*[F.sum(old).alias(new) for new, old in sums.items()])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    offsets = totals.select("_part", *[F.coalesce(F.sum(new).over(before), F.lit(0)).alias(f"_{new}") for new in sums])
    within = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = parted.join(F.broadcast(offsets), "_part")
    for new, old in sums.items():
        out = out.withColumn(new, F.sum(old).over(within) + F.col(f"_{new}"))
    return out.drop("_part", *[f"_{new}" for new in sums])


def _by_value(df: DataFrame, score: str, label: str) -> DataFrame:
    known = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    return known.groupBy(F.col(score).alias("score")).agg(F.sum(F.col(label).cast("long")).alias("pos"), F.count("*").alias("n"))


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row: area under the ROC curve by average ranks; null without both labels."""
    ranked = cumulate(_by_value(df, score, label), F.col("score").asc(), {"upto": "n"})
    rank = F.col("upto") - F.col("n") + (F.col("n") + 1) / 2.0
    sums = ranked.agg(F.sum(F.col("pos") * rank).alias("r"), F.sum("pos").cast("double").alias("p"), F.sum("n").cast("double").alias("n"))
    return sums.select(F.try_divide(F.col("r") - F.col("p") * (F.col("p") + 1) / 2, F.col("p") * (F.col("n") - F.col("p"))).alias("auc"))


def roc_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """(score, tp, fp) at every different score, from the highest down."""
    counts = _by_value(df, score, label).withColumn("neg", F.col("n") - F.col("pos"))
    return cumulate(counts, F.col("score").desc(), {"tp": "pos", "fp": "neg"}).select("score", "tp", "fp")


def enrichment(df: DataFrame, score: str, label: str, cutoffs: list[float]) -> DataFrame:
    """(cutoff, n, hits, rate, lift) of the rows at or above each cutoff; empty ones are left out."""
    hit = F.col(label).cast("long")
    aggs = [F.avg(F.col(label).cast("double")).alias("base")]
    for i, c in enumerate(cutoffs):
        aggs += [F.count(F.when(F.col(score) >= c, True)).alias(f"n{i}"), F.sum(F.when(F.col(score) >= c, hit)).alias(f"h{i}")]
    rows = F.array(*[F.struct(F.lit(float(c)).alias("cutoff"), F.col(f"n{i}").alias("n"), F.col(f"h{i}").alias("hits")) for i, c in enumerate(cutoffs)])
    long = df.agg(*aggs).select("base", F.explode(rows).alias("r")).select("base", "r.*").where("n > 0")
    rate = F.col("hits") / F.col("n").cast("double")
    return long.select("cutoff", "n", "hits", rate.alias("rate"), F.try_divide(rate, F.col("base")).alias("lift"))


def histogram(df: DataFrame, value: str, bins: int = 40) -> DataFrame:
    """(bin, n, density) over equal bins between the least and the greatest value; the greatest is in the last bin."""
    span = df.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"), F.count(value).alias("total"))
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.least(F.floor((F.col(value) - F.col("lo")) / width).cast("int"), F.lit(bins - 1)) + 1
    binned = df.where(F.col(value).isNotNull()).join(F.broadcast(span)).groupBy(F.when(width > 0, at).otherwise(F.lit(1)).alias("bin"), "total", width.alias("width"))  # span is one row
    return binned.agg(F.count("*").alias("n")).select("bin", "n", F.try_divide(F.col("n"), F.col("total") * F.col("width")).alias("density"))


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_g_{k}"]) for k in keys], F.lit(True))


def _ranked(counts: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows (keys, ..., n) with ``lo`` and ``hi``, the rows of their group before them and with them, and the group's ``total``.

    Running counts over all rows in the order of the groups are made by
    ranges, so no group is one task's; what lies before a group is its least.
    """
    upto = materialize(cumulate(counts, F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], *[c.alias(f"o{i}") for i, c in enumerate(order)]), {"upto": "n"}), "ranked")
    groups = upto.groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys]).agg(F.min(F.col("upto") - F.col("n")).alias("_before"), F.sum("n").alias("total"))
    joined = upto.join(groups, _same(upto, groups, keys)) if keys else upto.join(F.broadcast(groups))  # one row without keys
    return joined.withColumns({"hi": F.col("upto") - F.col("_before"), "lo": F.col("upto") - F.col("_before") - F.col("n")}).drop("upto", "_before", *[f"_g_{k}" for k in keys])


def quantiles(df: DataFrame, keys: list[str], value: str, at: list[float]) -> DataFrame:
    """(keys, at, quantile, total) of each group's values that aren't null, interpolated between neighbours; a null key is a group."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("n"))
    ranked = _ranked(counts, keys, [F.col("_v")])
    wanted = ranked.withColumn("at", F.explode(F.array(*[F.lit(float(p)) for p in at])))
    place = F.col("at") * (F.col("total") - 1)
    first, next_ = F.floor(place), F.least(F.floor(place) + 1, F.col("total") - 1)
    holds = lambda k: (F.col("lo") <= k) & (k < F.col("hi"))
    rows = wanted.where(holds(first) | holds(next_)).groupBy(*keys, "at", "total").agg(*[F.max(F.when(holds(k), F.col("_v"))).cast("double").alias(n) for k, n in ((first, "_a"), (next_, "_b"))])
    between = F.col("_a") + (F.col("_b") - F.col("_a")) * (place - F.floor(place))
    return rows.select(*keys, "at", F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(between).alias("quantile"), "total")


def top_share(df: DataFrame, keys: list[str], order: list[Column], share: float) -> DataFrame:
    """The first ``ceil(share * n)`` rows of each group of n, by an order that tells all its rows apart."""
    ranked = _ranked(df.withColumn("n", F.lit(1).cast("long")), keys, order)
    return ranked.where(F.col("hi") <= F.ceil(F.lit(float(share)) * F.col("total"))).select(*df.columns)


def describe(df: DataFrame, value: str) -> DataFrame:
    """One row: count, mean, std, min, quartiles (interpolated), max."""
    row = df.agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"))
    found = quantiles(df, [], value, [0.25, 0.5, 0.75])
    quartiles = found.agg(*[F.max(F.when(F.col("at") == p, F.col("quantile"))).alias(f"q{round(100 * p)}") for p in (0.25, 0.5, 0.75)])
    return row.join(F.broadcast(quartiles)).select("n", "mean", "std", "min", "q25", "q50", "q75", "max")  # one row each


def leaderboard(df: DataFrame, key: str, label: str) -> DataFrame:
    """(key, n, hits, rate) by group; rate half-even to two digits; rows without a key are left out."""
    hit = F.col(label).cast("int")
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"), F.sum(hit).cast("long").alias("hits"), F.bround(F.avg(hit.cast("double")), 2).alias("rate"))
