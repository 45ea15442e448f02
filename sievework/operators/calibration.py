"""Calibration of thresholds on candidates whose outcome is known."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions import stats
from sievework.sources.spreadsheet import read_spreadsheet

# The motif that natural ligands end in, and what marks a sequence as hard to make.
NATURAL_MOTIF = "F[YF][LM]M|CFYFLM|FVGLM"
HARD = "Difficult"


def read_table(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """A calibration table from a spreadsheet, CSV (with a header) or Parquet."""
    if path.lower().endswith(".xlsx"):
        return read_spreadsheet(spark, path, sheet)
    return spark.read.csv(path, header=True, inferSchema=True) if path.lower().endswith(".csv") else spark.read.parquet(path)


def derive(df: DataFrame, sequence: str, synthesis: str, ec50: str, potent: float = 100.0) -> DataFrame:
    """Add length, cysteines, motif and outcome columns.

    ``tested`` means the synthesis column says 1; ``active`` that a
    concentration was measured; ``hit`` that it is below ``potent``; a
    missing one is no hit.
    """
    s, made = F.coalesce(sequence, F.lit("")), F.coalesce(F.col(synthesis).cast("string"), F.lit(""))
    return df.withColumns(
        {
            "len": F.length(s),
            "n_cys": F.regexp_count(s, F.lit("C")),
            "disulfide": F.regexp_count(s, F.lit("C")) >= 2,
            "natural_motif": s.rlike(NATURAL_MOTIF),
            "tested": made.isin("1", "1.0"),
            "hard_synth": made.contains(HARD),
            "active": F.col(ec50).isNotNull(),
            "hit": F.coalesce(F.col(ec50) < potent, F.lit(False)),
        }
    )


def totals(df: DataFrame) -> DataFrame:
    """One row (submitted, tested, hard_synth, active, hits) of a derived table."""
    return df.agg(F.count("*").alias("submitted"), *[F.count_if(c).alias(n) for c, n in (("tested", "tested"), ("hard_synth", "hard_synth"), ("active", "active"), ("hit", "hits"))])


def separation(df: DataFrame, scores: list[str], label: str, negatives: str | None = None) -> DataFrame:
    """(score, auc, median_pos, median_neg), best first.

    All rows without the label are negatives of the AUC; the median of the
    negatives may be narrowed by a condition.
    """
    parts = []
    flag = F.coalesce(F.col(label).cast("boolean"), F.lit(False))
    side = ~flag & (F.expr(negatives) if negatives else F.lit(True))
    for name in scores:
        known = df.withColumn("_y", flag.cast("int"))
        sided = known.withColumn("_side", F.when(flag, "pos").when(side, "neg")).where("_side is not null")
        middle = stats.quantiles(sided, ["_side"], name, [0.5]).agg(*[F.max(F.when(F.col("_side") == s, F.col("quantile"))).alias(f"median_{s}") for s in ("pos", "neg")])
        parts.append(stats.auc(known, name, "_y").join(middle).select(F.lit(name).alias("score"), "auc", "median_pos", "median_neg"))  # one row each
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(F.desc_nulls_last("auc"), "score")


def combined(df: DataFrame, limits: dict[str, float], label: str) -> DataFrame:
    """One row: rows that reach all limits, their hits, hit rate, lift over the whole, and share of all hits."""
    hit, keep = F.col(label).cast("int"), F.lit(True)
    for name, least in limits.items():
        keep = keep & (F.col(name) >= least)
    row = df.agg(F.count(F.when(keep, 1)).alias("n"), F.coalesce(F.sum(F.when(keep, hit)), F.lit(0)).alias("hits"), F.avg(hit.cast("double")).alias("base"), F.sum(hit).alias("all"))
    rate = F.try_divide(F.col("hits").cast("double"), F.col("n"))
    return row.select("n", "hits", rate.alias("rate"), F.try_divide(rate, F.col("base")).alias("lift"), F.try_divide(F.col("hits").cast("double"), F.col("all")).alias("recall"))


def write_thresholds(path: str | Path, limits: dict) -> None:
    """Recommended thresholds as JSON."""
    Path(path).write_text(json.dumps(limits, indent=2, ensure_ascii=False), encoding="utf-8")
