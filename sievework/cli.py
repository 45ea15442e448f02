"""Command line: prepare, generate, validate, filter, rank, review, export."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sievework.functions import metrics
from sievework.operators import gates, novelty
from sievework.operators import rank as ranking
from sievework.operators.structures import structure_pairs
from sievework.plans.export import ExportBlocked, export
from sievework.plans.review import build_context, http_reviewer, run_review
from sievework.plans.shared import materialize, temporary
from sievework.session import get_session
from sievework.sources import files
from sievework.sources.config import load_profile, load_yaml, target_id
from sievework.sources.registry import Registry, decode


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="sievework", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def add(name: str, **options) -> None:
        sub = commands.add_parser(name)
        sub.add_argument("--target", required=True)
        for key, value in options.items():
            flag = "--" + key.replace("_", "-")
            if isinstance(value, bool):
                sub.add_argument(flag, action="store_true")
            elif isinstance(value, tuple):
                sub.add_argument(flag, type=value[0], required=True)
            else:
                sub.add_argument(flag, type=type(value) if value is not None else str, default=value)

    add("prepare")
    add("generate", pipelines=None, budget=2000)
    add("validate", predictors="boltz2,af2multimer,chai1,esmfold", db=None)
    add("filter", profile=(str,), known=None, pdb=None, lists=None, db=None)
    add("rank", quota=100, cluster_tm=0.6, pairs=None, keep_clusters=False, db=None)
    add("review", stage="all", profile=None, db=None, runs_root="runs", submission=None, out=None, fail_on="block", semantic=False, semantic_endpoint=None)
    add("export", out=(str,), profile=None, db=None, runs_root="runs", quota=None, fail_on="block", allow_blocked=False)
    return parser


def _similar_structures(spark, registry, target, rows, args):
    """Pairs of the designs' structures at the clusters' similarity; designs without a readable one have none."""
    bases = build_context(spark, registry, target, target_path=args.target, repo_root=Path.cwd()).bases
    read = files.traces(rows.select(F.col("structure_path").alias("path")), bases).where("xyz is not null").select(F.col("path").alias("structure_path"), "xyz")
    traces = rows.select(F.col("design_id").alias("id"), "structure_path").join(read, "structure_path")
    return materialize(structure_pairs(traces.select("id", "xyz"), args.cluster_tm), "structure-pairs")


def main(argv: list[str] | None = None, spark=None) -> int:
    """Run a command; returns the exit code."""
    args = _parser().parse_args(argv)
    target = target_id(args.target)
    if args.command == "prepare":
        raise NotImplementedError("structures are prepared by external tools; register their output with a Run")
    if args.command == "generate":
        cfg = load_yaml(args.target)
        mix = {k: float(v.get("share", 1) if isinstance(v, dict) else v) for k, v in ((cfg.get("budget") or {}).get("pipeline_mix") or cfg.get("pipeline_mix") or {}).items()}
        wanted = args.pipelines.split(",") if args.pipelines else list(mix)
        shares = {p: mix.get(p, 1.0) for p in wanted}
        for pipeline, n in ranking.apportion(args.budget, shares).items():
            print(f"[generate] {pipeline}: {n}")
        return 0
    spark = spark or get_session()
    with temporary(spark):
        return _run(spark, args, target)


def _run(spark: SparkSession, args: argparse.Namespace, target: str) -> int:
    """Run a command that works on the registry."""
    registry = Registry(spark, args.db or str(Path("runs") / target / "registry"))
    if args.command == "validate":
        ctx = build_context(spark, registry, target, target_path=args.target, repo_root=Path.cwd())
        wanted = args.predictors.split(",")
        found = ctx.parsed().where(F.col("predictor").isin(wanted)).groupBy("design_id").agg(F.map_from_entries(F.collect_list(F.struct("predictor", "values"))).alias("by"))
        counted = found.select("design_id", metrics.agree_simple(F.col("by"), "iptm").cast("int").alias("predictors_agreeing"), F.lit("validate").alias("stage"))
        registry.update(counted)
        print(f"[validate] {target}: {counted.count()}")
        return 0
    if args.command == "filter":
        profile, read = load_profile(args.profile), lambda path: files.read_fasta(spark, [path])
        lists = dict(x.split("=", 1) for x in args.lists.split(",")) if args.lists else {}
        rows = novelty.measured(decode(registry.query_target(target)), profile, read(args.known) if args.known else None, read(args.pdb) if args.pdb else None, {k: read(v) for k, v in lists.items()})
        rows = ranking.filter_stage(rows, profile).withColumn("liability_flags", F.concat("liability_flags", F.transform("copy_of", lambda n: F.concat(F.lit(gates.HARD + "copy_of_"), n))))
        registry.update(rows.select("design_id", "passed_screen", "passed_select", F.to_json("liability_flags").alias("liability_flags"), F.lit("filter").alias("stage")))
        row = rows.agg(F.count(F.when(F.col("passed_select"), 1)).alias("passed"), F.count(F.when(F.col("passed_select") & ~gates.open_to(F.col("liability_flags")), 1)).alias("shut")).first()
        print(f"[filter] {target}: {row['passed']} pass, {row['shut']} of them held back by gates")
        return 0
    if args.command == "rank":
        every = decode(registry.query_target(target))
        rows = every.where(F.coalesce("passed_select", F.lit(False)) & gates.open_to(F.col("liability_flags"))).withColumn("_low", metrics.lower_keys(F.col("metrics")))
        rows = rows.withColumns({"final_score": ranking.with_selectivity(ranking.final_score(F.col("_low"), F.col("predictors_agreeing")), F.col("_low"), load_yaml(args.target)), "_missing": ranking.missing_terms(F.col("_low"), F.col("predictors_agreeing"))})
        for r in rows.select(F.explode("_missing").alias("term")).groupBy("term").agg(F.count("*").alias("n")).orderBy("term").collect():  # a row a term of the score
            print(f"[rank] warning: {r['n']} designs have no {r['term']}; it counts as 0", file=sys.stderr)
        if not args.keep_clusters:
            pairs = spark.read.parquet(args.pairs) if args.pairs else _similar_structures(spark, registry, target, rows, args)
            clusters = ranking.leader_clusters(pairs, rows.select(F.col("design_id").alias("id"), F.col("final_score").alias("score")), args.cluster_tm)
            rows = rows.drop("cluster_id").join(ranking.number_clusters(clusters).withColumnRenamed("id", "design_id"), "design_id")
        rows = materialize(rows, "ranked")
        chosen = materialize(ranking.round_robin(rows, args.quota, reserve=0.15).select("design_id", F.lit(True).alias("_chosen")), "chosen")
        ranked = rows.join(chosen, "design_id", "left").select("design_id", "final_score", "cluster_id", F.coalesce("_chosen", F.lit(False)).alias("selected"), F.lit("rank").alias("stage"))
        stale = every.where(F.coalesce("selected", F.lit(False))).join(rows.select("design_id"), "design_id", "left_anti")  # selected before, out of the running now
        registry.update(ranked.unionByName(stale.select("design_id", "final_score", "cluster_id", F.lit(False).alias("selected"), "stage")))
        print(f"[rank] {target}: {chosen.count()} selected")
        return 0
    if args.command == "review":
        ctx = build_context(
            spark, registry, target, target_path=args.target, profile_path=args.profile, runs_root=args.runs_root,
            repo_root=Path.cwd(), package=args.submission, scope=args.stage,
        )
        if args.semantic and not args.semantic_endpoint:
            raise SystemExit("--semantic needs --semantic-endpoint")
        report = run_review(ctx, http_reviewer(args.semantic_endpoint) if args.semantic else None)
        report.write(args.out or Path(args.runs_root) / target / "review", args.fail_on)
        print(f"[review] {target}: {report.counts}")
        return report.exit_code(args.fail_on)
    try:
        done = export(
            spark, registry, target, args.out, target_path=args.target, profile_path=args.profile, runs_root=args.runs_root,
            repo_root=Path.cwd(), quota=int(args.quota) if args.quota else None, fail_on="none" if args.allow_blocked else args.fail_on,
        )
    except ExportBlocked as error:
        print(f"[export] {error}", file=sys.stderr)
        return 1
    print(f"[export] {done['n_selected']} designs in {done['out_dir']}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
