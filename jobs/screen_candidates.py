"""Screen the candidates of all targets and shortlist the best of every cluster.

Candidates are line items, their target is the order's priority and their
cluster the part's brand.  Each gets its verdict at both threshold levels
and a final score; the output holds, for every target and cluster, how many
candidates there were at each level and the best ``per_cluster`` of those
that passed both.  A cluster without any has one row with place 0.

The output is partitioned by target.  A run over all targets replaces it, a
run over some replaces their partitions only, so a rerun gives the same.
The best rows of a cluster are limited before they are shuffled, and counts
are partial, so a cluster may be of any size.

    python -m jobs.screen_candidates --input DIR --output DIR [--config FILE] [--target T ...]
"""

from __future__ import annotations

import argparse
import logging
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework.functions import metrics
from sievework.operators import rank
from sievework.session import get_session

log = logging.getLogger("jobs.screen_candidates")
CONFIG = Path(__file__).with_suffix(".yaml")
ID = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def load_config(path: str | Path = CONFIG) -> dict:
    return yaml.safe_load(Path(path).read_text(encoding="utf-8"))


def _metric_map(columns: dict[str, str]):
    return F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).cast("double").alias("v")) for k, c in columns.items()]), lambda e: e["v"].isNotNull()))


def candidates(spark: SparkSession, source: str, config: dict) -> DataFrame:
    """Every candidate with target, cluster, the verdicts of both levels and its score; without an order or part these are ``none``."""
    read = lambda name: spark.read.parquet(f"{source.rstrip('/')}/{name}.parquet")
    columns = sorted({*ID, *config["metrics"].values(), *config["score"].values()})
    rows = read("lineitem").select(*columns)
    targets = read("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("target"))
    clusters = read("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("cluster"))
    rows = rows.join(targets, "l_orderkey", "left").join(clusters, "l_partkey", "left").withColumns({c: F.coalesce(c, F.lit("none")) for c in ("target", "cluster")})
    if config.get("targets"):
        rows = rows.where(F.col("target").isin(*config["targets"]))
    low, agreeing = metrics.lower_keys(_metric_map(config["metrics"])), F.pmod("l_linenumber", F.lit(4)).cast("int")
    rows = rows.withColumns({"_low": low, "_score": metrics.lower_keys(_metric_map(config["score"])), "_agreeing": agreeing})
    rows, values = metrics.bind(rows, F.col("_low"), config["profile"])
    level = lambda name: metrics.passes_level(values, F.col("_agreeing"), config["profile"], name)
    score = F.round(rank.final_score(F.col("_score"), F.col("_agreeing")), 9)
    return rows.select("target", "cluster", *ID, level("screen").alias("screen"), level("select").alias("select"), score.alias("score"))


def shortlist(rows: DataFrame, per_cluster: int) -> DataFrame:
    """Counts of every target and cluster with its best candidates."""
    keys = ["target", "cluster"]
    counts = rows.groupBy(*keys).agg(F.count("*").alias("candidates"), F.count_if("screen").alias("screened"), F.count_if(F.col("screen") & F.col("select")).alias("passed"))
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), *ID)
    top = rows.where("screen and select").select(*keys, *ID, "score", F.row_number().over(best).alias("place")).where(F.col("place") <= per_cluster)
    joined = counts.join(top, keys, "left").withColumn("place", F.coalesce("place", F.lit(0)))
    return joined.select("cluster", "candidates", "screened", "passed", "place", *ID, "score", "target")


def run(spark: SparkSession, source: str, output: str, config: dict) -> DataFrame:
    """Compute and write the shortlists; returns the whole output read back."""
    log.info("reading lineitem, orders and part of %s; targets: %s", source, config.get("targets") or "all")
    found = shortlist(candidates(spark, source, config), int(config["per_cluster"]))
    how = "dynamic" if config.get("targets") else "static"
    found.write.mode("overwrite").option("partitionOverwriteMode", how).partitionBy("target").parquet(output)
    written = spark.read.schema(found.schema).parquet(output)
    read = F.sum(F.when(F.col("place") <= 1, F.col("candidates")))  # each cluster has one row of place 0 or 1
    for row in written.groupBy("target").agg(read.alias("read"), F.count("*").alias("n"), F.count("score").alias("best")).orderBy("target").collect():  # a row a target
        log.info("target %s: read %d candidates; wrote %d rows to %s, %d candidates on the shortlist", row["target"], row["read"], row["n"], output, row["best"])
    return written


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="jobs.screen_candidates", description=__doc__)
    parser.add_argument("--input", required=True, help="folder of the tables lineitem, orders and part")
    parser.add_argument("--output", required=True)
    parser.add_argument("--config", default=str(CONFIG))
    parser.add_argument("--target", action="append", help="compute this target only; may be repeated")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    config = load_config(args.config)
    spark = get_session("screen-candidates")
    try:
        run(spark, args.input, args.output, config | ({"targets": args.target} if args.target else {}))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
