"""The audit: thirteen rules, each a plan from a context to findings.

Severities say what may pass: BLOCK stops an export, WARN asks for a look,
INFO tells what couldn't be checked.  Missing data is always told; silence
is no pass.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework import schema
from sievework.functions import metrics, sequences
from sievework.operators.ancestry import CYCLE, ancestry
from sievework.plans.provenance import verify_artifacts, verify_entries
from sievework.plans.shared import materialize
from sievework.sources import files

BLOCK, WARN, INFO = "BLOCK", "WARN", "INFO"
RANK = {INFO: 0, WARN: 1, BLOCK: 2}
STAGES_WITH_STRUCTURE = ("validate", "filter", "rank", "export")
# Metrics that only the licensed toolchain computes, its licence, and the pipeline that needs it.
LICENSED_METRICS = ("shape_complementarity", "dG_separated", "sap_score", "sc", "ddG")
LICENSED, LICENSED_PIPELINE = "pyrosetta-dependent", "bindcraft"
TOLERANCE = 1e-3
# Predictor metrics and the threshold they are recorded under; ptm isn't the interface's and has none.
RECORDED_AS = {"plddt": "pLDDT_binder", "iptm": "i_pTM", "i_pae": "i_PAE", "rmsd": "monomer_rmsd_A", "boltz2_affinity_prob": "boltz2_affinity_prob"}


@dataclass
class Context:
    """What an audit sees: decoded designs of one target, manifests, configurations and places of files."""

    spark: SparkSession
    target_id: str
    designs: DataFrame
    runs: DataFrame
    profile: dict = field(default_factory=dict)
    target: dict = field(default_factory=dict)
    hashes: dict[str, str] = field(default_factory=dict)
    bases: list[str] = field(default_factory=list)
    quota: int | None = None
    package: str | None = None
    scope: str = "all"
    #: Artifacts of the runs, a row each; if it is missing, those that ``runs`` holds.
    entries: DataFrame | None = None
    _parsed: DataFrame | None = None

    @property
    def selected(self) -> DataFrame:
        return self.designs.where(F.coalesce("selected", F.lit(False)))

    def parsed(self) -> DataFrame:
        """(design_id, predictor, path, found, values): every predictor output, read once for all rules."""
        if self._parsed is None:
            outputs = self.designs.select("design_id", F.explode("predictor_outputs").alias("predictor", "path"))
            values = files.predictor_metrics(outputs, self.bases)
            self._parsed = materialize(outputs.join(values, "path", "left"), "predictors")
        return self._parsed


def _text(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("string")


def finding(rows: DataFrame, rule: str, severity, message, design_id=None, artifact=None, expected=None, actual=None) -> DataFrame:
    """Findings with one row a row of ``rows``; values are columns or constants."""
    values = (rule, severity, message, design_id, artifact, expected, actual)
    return rows.select(*[_text(v).alias(f.name) for v, f in zip(values, schema.FINDINGS, strict=True)])


def note(ctx: Context, rule: str, severity: str, message: str, **more: str) -> DataFrame:
    """One finding that isn't about a row."""
    return finding(ctx.spark.range(1), rule, severity, message, **more)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _id() -> Column:
    return F.col("design_id")


def lineage(ctx: Context) -> DataFrame:
    if not ctx.hashes:
        return note(ctx, "R1", INFO, "no configurations found, lineage not checked")
    d = ctx.designs
    known = ctx.spark.createDataFrame([(h,) for h in ctx.hashes], "config_hash string")  # a row a configuration file
    stray = d.join(F.broadcast(known), "config_hash", "left_anti")
    other = d.where(~F.col("target_id").eqNullSafe(F.lit(ctx.target_id)))
    child = d.where(F.coalesce("parent_id", F.lit("")) != "")
    orphan = child.join(d.select(F.col("design_id").alias("parent_id")), "parent_id", "left_anti")
    rings = d.select("design_id", F.nullif("parent_id", F.lit("")).alias("parent_id"))
    ring = ancestry(rings).where(F.col("ends") == CYCLE).select(F.col("id").alias("design_id"))
    return union(
        [
            finding(stray, "R1", BLOCK, "config_hash matches no present configuration", _id(), expected="hash of a configuration", actual=F.col("config_hash")),
            finding(other, "R1", BLOCK, "target_id isn't the audited target", _id(), expected=ctx.target_id, actual=F.col("target_id")),
            finding(orphan, "R1", BLOCK, "parent_id isn't in the registry", _id(), expected="a registered design_id", actual=F.col("parent_id")),
            finding(ring, "R1", BLOCK, "the parents run in a ring", _id(), expected="a first ancestor"),
        ]
    )


def sequence(ctx: Context) -> DataFrame:
    text = F.coalesce("sequence", F.lit(""))
    d = ctx.designs.withColumn("_n", F.length(text)).withColumn("_bad", sequences.illegal_characters(text))
    parts = [
        finding(d.where(~F.col("length").eqNullSafe(F.col("_n"))), "R2", BLOCK, "length isn't the sequence's", _id(), expected=F.col("_n"), actual=F.col("length")),
        finding(d.where("_bad <> ''"), "R2", BLOCK, "characters that are no natural amino acid", _id(), expected="20 natural amino acids", actual=F.col("_bad")),
    ]
    bounds = (ctx.target.get("modality") or {}).get("binder_length")
    if isinstance(bounds, list | tuple) and len(bounds) == 2:
        outside = d.where(~F.col("_n").between(*bounds))
        parts.append(finding(outside, "R2", BLOCK, "length outside the target's bounds", _id(), expected=f"{bounds[0]}-{bounds[1]} aa", actual=F.concat("_n", F.lit(" aa"))))
    return union(parts)


def _with_file(ctx: Context, rows: DataFrame) -> DataFrame:
    """Rows with ``found`` and ``size`` of their structure file."""
    probed = files.probe(rows.select(F.col("structure_path").alias("path")), ctx.bases).withColumnRenamed("path", "structure_path")
    return rows.join(probed, "structure_path", "left")


def structure(ctx: Context) -> DataFrame:
    path = F.coalesce("structure_path", F.lit(""))
    late = F.coalesce(F.col("stage").isin(*STAGES_WITH_STRUCTURE), F.lit(False)) | F.coalesce("passed_screen", F.lit(False))
    none = ctx.designs.where((path == "") & late)
    f = _with_file(ctx, ctx.designs.where(path != "")).withColumn("_suffix", F.lower(F.regexp_extract("structure_path", r"\.[^./]+$", 0)))
    at = F.col("structure_path")
    return union(
        [
            finding(none, "R3", BLOCK, "past refolding or screening without a structure", _id(), expected="path of a pdb or cif file", actual="None"),
            finding(f.where("size is null"), "R3", BLOCK, "structure file doesn't exist", _id(), at, "a file", "missing"),
            finding(f.where("size = 0"), "R3", BLOCK, "structure file is empty", _id(), at),
            finding(f.where("size > 0 and _suffix not in ('.pdb', '.cif')"), "R3", BLOCK, "structure file's type isn't supported", _id(), at, ".pdb/.cif", F.col("_suffix")),
        ]
    )


def sequence_of_structure(ctx: Context) -> DataFrame:
    rows = ctx.designs.where(F.coalesce("structure_path", F.lit("")) != "")
    read = files.structures(rows.select(F.col("structure_path").alias("path")), ctx.bases)
    read = read.select(F.col("path").alias("structure_path"), F.col("sequence").alias("_read"), "error")
    joined = rows.join(read, "structure_path")
    odd = F.col("_read").contains("X")
    differ = joined.where(~odd & (F.col("_read") != F.coalesce("sequence", F.lit(""))))
    at = F.col("structure_path")
    return union(
        [
            finding(joined.where("error is not null"), "R4", BLOCK, F.concat(F.lit("structure: "), "error"), _id(), at),
            finding(joined.where(odd), "R4", INFO, "non-standard residues, sequence not compared", _id(), at),
            finding(differ, "R4", BLOCK, "the structure's binder chain isn't the recorded sequence", _id(), at, F.col("sequence"), F.col("_read")),
        ]
    )


def recomputed_metrics(ctx: Context) -> DataFrame:
    late = F.coalesce(F.col("stage").isin(*STAGES_WITH_STRUCTURE), F.lit(False))
    without = ctx.designs.where(F.size("predictor_outputs") == 0)
    parsed = ctx.parsed()
    # A predictor whose path leads nowhere is told by itself and doesn't hide the others.
    lost = parsed.where("path is null or found is null")
    empty = parsed.groupBy("design_id").agg(F.max(F.coalesce(F.size("values"), F.lit(0))).alias("n")).where("n <= 0")
    wanted = F.create_map(*[F.lit(x) for kv in RECORDED_AS.items() for x in kv])
    values = parsed.select("design_id", "predictor", "path", F.explode("values").alias("metric", "value"))
    recorded = [F.struct(F.lit(k).alias("config"), metrics.resolve(F.col("_low"), k).alias("recorded")) for k in sorted(set(RECORDED_AS.values()))]
    own = ctx.designs.select("design_id", metrics.lower_keys(F.col("metrics")).alias("_low")).select("design_id", F.explode(F.array(*recorded)).alias("r")).select("design_id", "r.*")
    both = values.withColumn("config", F.try_element_at(wanted, F.col("metric"))).join(own.where("recorded is not null"), ["design_id", "config"])
    off = F.abs(F.col("recorded") - F.col("value"))
    wrong = both.where(~F.isnan(off) & (off > TOLERANCE))
    return union(
        [
            finding(without, "R5", F.when(late, WARN).otherwise(INFO), "no predictor output, metrics not recomputed", _id()),
            finding(lost, "R5", WARN, F.concat("predictor", F.lit(": output file not found")), _id(), F.col("path")),
            finding(empty, "R5", WARN, "no metric could be read from the predictor outputs", _id()),
            finding(wrong, "R5", BLOCK, F.concat("predictor", F.lit(": "), "metric", F.lit(" isn't the recorded value")), _id(), F.col("path"), F.col("value"), F.col("recorded")),
        ]
    )


def threshold_replay(ctx: Context) -> DataFrame:
    if not ctx.profile:
        return note(ctx, "R6", INFO, "no filter profile, thresholds not replayed")
    d, values = metrics.bind(ctx.designs.withColumn("_low", metrics.lower_keys(F.col("metrics"))), F.col("_low"), ctx.profile)
    parts = []
    for level, claim in (("screen", "passed_screen"), ("select", "passed_select")):
        now = d.withColumn("_now", metrics.passes_level(values, F.col("predictors_agreeing"), ctx.profile, level))
        wrong = now.where(F.col(claim).isNotNull() & (F.col(claim) != F.col("_now")))
        failed = F.array_join(metrics.failed_keys(values, ctx.profile, level), ", ")
        told = F.concat(F.initcap(F.col("_now").cast("string")), F.when(failed != "", F.concat(F.lit(", failed: "), failed)).otherwise(""))
        parts.append(finding(wrong, "R6", BLOCK, f"{claim} isn't what the present thresholds give", _id(), expected=told, actual=F.initcap(F.col(claim).cast("string"))))
    if metrics.min_agreeing(ctx.profile) is not None:
        parts.append(finding(d.where("predictors_agreeing is null"), "R6", INFO, "predictors_agreeing is missing and counted as 0", _id()))
    return union(parts)


def agreeing(ctx: Context, level: str = "screen") -> DataFrame:
    """(design_id, agreeing): predictors with a measured folding metric and none that fails, for designs with outputs."""
    low = ctx.parsed().withColumn("_low", metrics.lower_keys(F.col("values")))
    tests = [p for _, _, p in metrics.verdicts(F.col("_low"), ctx.profile, level, ("folding_confidence",))]
    if not tests:
        return low.groupBy("design_id").agg(F.lit(0).cast("long").alias("agreeing"))
    measured, fine = reduce(lambda a, b: a | b, [t.isNotNull() for t in tests]), reduce(lambda a, b: a & b, [t.isNull() | t for t in tests])
    return low.groupBy("design_id").agg(F.count(F.when(measured & fine, True)).alias("agreeing"))


def cross_predictor(ctx: Context) -> DataFrame:
    if not ctx.profile:
        return note(ctx, "R7", INFO, "no filter profile, agreement not checked")
    rows = ctx.designs.where(F.size("predictor_outputs") > 0)
    if rows.isEmpty():
        return note(ctx, "R7", INFO, "no predictor output, agreement not checked")
    d = rows.join(agreeing(ctx), "design_id")
    parts = [
        finding(d.where("predictors_agreeing <> agreeing"), "R7", BLOCK, "predictors_agreeing isn't the count recomputed", _id(), expected=F.col("agreeing"), actual=F.col("predictors_agreeing"))
    ]
    if (least := metrics.min_agreeing(ctx.profile)) is not None:
        few = d.where((F.col("agreeing") < least) & F.coalesce("passed_screen", F.lit(False)))
        parts.append(finding(few, "R7", BLOCK, "passed screening with too few agreeing predictors", _id(), expected=f">= {least}", actual=F.col("agreeing")))
    return union(parts)


def licence(ctx: Context) -> DataFrame:
    d, has = ctx.designs, F.col("toolchain_license")
    needs = F.lower(F.coalesce("pipeline", F.lit(""))).contains(LICENSED_PIPELINE)
    physics = ctx.profile.get("interface_physics") or {}
    gated = [m for m in LICENSED_METRICS if not (isinstance(physics.get(m), dict) and physics[m].get("enabled") is True)]
    used = d.select("design_id", F.explode(F.array_intersect("metric_names", F.array(*map(F.lit, gated)))).alias("m")) if gated else None
    parts = [
        finding(d.where(has.isNull()), "R8", WARN, "toolchain_license is missing", _id()),
        finding(d.where(needs & (has != LICENSED)), "R8", BLOCK, "this pipeline's designs must carry its licence", _id(), expected=LICENSED, actual=has),
        finding(d.where(~needs & (has == LICENSED)), "R8", BLOCK, "licence of another pipeline", _id(), expected="permissive", actual=has),
    ]
    if used is not None:
        parts.append(finding(used, "R8", BLOCK, F.concat(F.lit("metric "), "m", F.lit(" needs a licensed tool that the profile doesn't enable")), _id(), F.col("m")))
    return union(parts)


def hashes(ctx: Context) -> DataFrame:
    own = ctx.designs.select("design_id", "run_id", F.explode("artifact_hashes").alias("rel", "expected"))
    if ctx.runs.isEmpty() and own.isEmpty():
        return note(ctx, "R9", INFO, "no manifest and no registered hash, nothing reconciled")
    broken = verify_artifacts(ctx.runs) if ctx.entries is None else verify_entries(ctx.entries)
    placed = own.join(F.broadcast(ctx.runs.select("run_id", "run_dir")) if ctx.runs.count() < 100_000 else ctx.runs.select("run_id", "run_dir"), "run_id", "left")
    placed = placed.withColumn("path", F.when(F.col("run_dir").isNull() | F.col("rel").rlike("^/|://"), F.col("rel")).otherwise(F.concat_ws("/", "run_dir", "rel")))
    checked = placed.join(files.probe(placed, ctx.bases, hashed=True), "path", "left")
    changed = checked.where("sha256 is not null and sha256 <> expected")
    return union(
        [
            finding(broken, "R9", BLOCK, F.concat(F.lit("run "), "run_id", F.lit(": "), "path", F.lit(" "), "reason"), None, F.col("path"), F.col("expected"), F.coalesce("actual", F.lit("None"))),
            finding(checked.where("sha256 is null"), "R9", BLOCK, "registered artifact doesn't exist", _id(), F.col("rel"), F.col("expected"), "missing"),
            finding(changed, "R9", BLOCK, "registered artifact was changed", _id(), F.col("rel"), F.col("expected"), F.col("sha256")),
        ]
    )


def code_pin(ctx: Context) -> DataFrame:
    if ctx.runs.isEmpty():
        return note(ctx, "R10", INFO, "no manifest, code version not checked")
    severity, at = F.when(F.col("stage") == "export", BLOCK).otherwise(WARN), F.concat(F.lit("run "), "run_id")
    return union(
        [
            finding(ctx.runs.where(F.coalesce("code_rev", F.lit("")) == ""), "R10", severity, "the manifest names no code version", None, at),
            finding(ctx.runs.where("code_dirty"), "R10", severity, "the code had uncommitted changes", None, at, "code_dirty=false", "true"),
        ]
    )


def quota(ctx: Context) -> DataFrame:
    chosen = ctx.selected
    if chosen.isEmpty():
        return note(ctx, "R11", INFO, "nothing selected, quota not checked")
    parts = [finding(chosen.where("cluster_id is null"), "R11", BLOCK, "selected without a cluster", _id())]
    if ctx.quota is not None:
        over = chosen.agg(F.count("*").alias("n")).where(F.col("n") > ctx.quota)
        parts.append(finding(over, "R11", BLOCK, "more selected than the quota", expected=f"<= {ctx.quota}", actual=F.col("n")))
    cap = (ctx.profile.get("diversity") or {}).get("max_per_cluster") or (ctx.target.get("budget") or {}).get("max_per_cluster")
    if cap:
        many = chosen.groupBy("cluster_id").agg(F.count("*").alias("n")).where(F.col("n") > cap)
        name = F.concat(F.lit("cluster "), F.coalesce(F.col("cluster_id").cast("string"), F.lit("None")), F.lit(" has too many selected"))
        parts.append(finding(many, "R11", BLOCK, name, expected=f"<= {cap}", actual=F.col("n")))
    else:
        parts.append(note(ctx, "R11", INFO, "no max_per_cluster configured, clusters not checked"))
    return union(parts)


def sides(package: DataFrame, selection: DataFrame, key: str) -> DataFrame:
    """(key, in_package, in_selection) of every different value of both; null is no value."""
    sided = [rows.select(key).where(F.col(key).isNotNull()).withColumns({"in_package": F.lit(p), "in_selection": F.lit(not p)}) for rows, p in ((package, True), (selection, False))]
    return sided[0].union(sided[1]).groupBy(key).agg(F.bool_or("in_package").alias("in_package"), F.bool_or("in_selection").alias("in_selection"))


def package(ctx: Context) -> DataFrame:
    listed = list_package(ctx.spark, ctx.package)
    if listed is None:
        return note(ctx, "R12", INFO, "no package folder, package not checked")
    fastas = [p for p in listed if p.endswith((".fasta", ".fa"))]
    if not fastas:
        return note(ctx, "R12", BLOCK if ctx.scope == "export" else WARN, "no FASTA file in the package", artifact=ctx.package)
    both = sides(files.read_fasta(ctx.spark, fastas), ctx.selected, "sequence")
    counts = both.agg(
        F.count_if("in_package").alias("i"), F.count_if("in_selection").alias("s"),
        F.count_if(~F.col("in_selection")).alias("only_i"), F.count_if(~F.col("in_package")).alias("only_s"),
    ).where("only_i + only_s > 0")
    told = F.concat(F.lit("FASTA and selection differ: only in the package "), "only_i", F.lit(", only selected "), "only_s")
    parts = [finding(counts, "R12", BLOCK, told, None, ctx.package, F.concat(F.lit("selected "), "s"), F.concat(F.lit("FASTA "), "i"))]
    missing = _with_file(ctx, ctx.selected.where(F.coalesce("structure_path", F.lit("")) != "")).where("found is null").select("design_id")
    missing = missing.unionByName(ctx.selected.where(F.coalesce("structure_path", F.lit("")) == "").select("design_id"))
    parts.append(finding(missing, "R12", BLOCK, "structure of a selected design is missing", _id()))
    texts = [p for p in listed if p.rsplit("/", 1)[-1].startswith(("methods", "METHODS")) and p.endswith(".md")]
    if texts:
        claims = ctx.spark.read.text(texts, wholetext=True).select(F.input_file_name().alias("file"), "value").where(F.col("value").contains(LICENSED))
        if not claims.isEmpty() and ctx.selected.where(F.col("toolchain_license") == LICENSED).isEmpty():
            parts.append(finding(claims, "R12", BLOCK, "the methods text names a licence that no selected design has", None, F.regexp_extract("file", "[^/]+$", 0)))
    return union(parts)


def list_package(spark: SparkSession, folder: str | None) -> list[str] | None:
    """Paths of the files of a package folder; None if there's no folder."""
    if not folder:
        return None
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in fs.listStatus(path) if s.isFile()) if fs.exists(path) else None


def repeated(designs: DataFrame) -> DataFrame:
    """(design_id, first_id, n, sequence) of the designs whose sequence occurs n times, more than once; the smallest id is its first.

    Sequences are counted by hash before any is joined, so one that very
    many designs share is split by adaptive execution like any large key.
    """
    key = F.sha2("sequence", 256)
    counted = designs.groupBy(key.alias("_key")).agg(F.count("*").alias("n"), F.min("design_id").alias("first_id")).where("n > 1 and _key is not null")
    return designs.select("design_id", "sequence", key.alias("_key")).join(counted, "_key").select("design_id", "first_id", "n", "sequence")


def duplicates(ctx: Context) -> DataFrame:
    """One finding a repeated sequence, at its first design; ``repeated`` tells the others."""
    if ctx.selected.isEmpty():
        return note(ctx, "R13", INFO, "nothing selected, duplicates not checked")
    same = ctx.selected.groupBy("sequence").agg(F.count("*").alias("n"), F.min("design_id").alias("design_id")).where("n > 1")
    return finding(same, "R13", WARN, "one sequence is selected more than once", _id(), expected="once", actual=F.concat("n", F.lit(" times: "), "sequence"))


#: (id, title, plan, whether it runs for exports only), in the order of the audit.
RULES: list[tuple[str, str, Callable[[Context], DataFrame], bool]] = [
    ("R1", "lineage", lineage, False),
    ("R2", "sequence", sequence, False),
    ("R3", "structure exists", structure, False),
    ("R4", "sequence of the structure", sequence_of_structure, False),
    ("R5", "metrics recomputed", recomputed_metrics, False),
    ("R6", "thresholds replayed", threshold_replay, False),
    ("R7", "agreement of predictors", cross_predictor, False),
    ("R8", "licence", licence, False),
    ("R9", "hashes reconciled", hashes, False),
    ("R10", "code pinned", code_pin, False),
    ("R11", "quota and clusters", quota, False),
    ("R12", "package", package, True),
    ("R13", "duplicates", duplicates, False),
]
