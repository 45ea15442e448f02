"""Running the audit and reporting it."""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework import schema
from sievework.functions import stats
from sievework.operators.rules import BLOCK, INFO, RANK, RULES, WARN, Context, note, union
from sievework.plans.provenance import read_entries, read_runs, utc_now
from sievework.plans.shared import materialize
from sievework.sources.config import config_hashes, load_profile, load_yaml
from sievework.sources.files import open_uri, write_text
from sievework.sources.registry import Registry, decode


def build_context(
    spark: SparkSession, registry: Registry, target_id: str, *, target_path=None, profile_path=None, runs_root=None,
    configs_dir=None, repo_root=None, quota=None, package=None, scope="all", strict_profile=False,
) -> Context:
    """A context over all stages of a target; the quota defaults to the target's budget."""
    target = load_yaml(target_path) if target_path else {}
    budget = (target.get("budget") or {}).get("submit_quota")
    configs = configs_dir or (Path(repo_root) / "configs" if repo_root else None)
    bases = [str(Path(b).resolve()) if "://" not in str(b) else str(b) for b in (repo_root, runs_root, Path.cwd()) if b]
    return Context(
        spark, target_id, materialize(decode(registry.query_target(target_id)), "designs"),
        materialize(read_runs(spark, str(runs_root), target_id), "runs") if runs_root else spark.createDataFrame([], schema.MANIFEST).withColumn("run_dir", F.lit(None).cast("string")),
        load_profile(profile_path, strict_profile) if profile_path else {}, target, config_hashes(configs) if configs else {}, bases,
        quota if quota is not None else int(budget) if budget is not None else None, str(package) if package else None, scope,
        read_entries(spark, str(runs_root), target_id) if runs_root else None,
    )


#: Findings that a report holds at most; beyond, all are written beside it.
HEAD = 10_000


class Report:
    """Findings of an audit and what follows from them."""

    def __init__(self, target_id: str, findings: DataFrame, rules_run: list[str]):
        self.target_id, self.findings, self.rules_run, self.generated_at = target_id, findings, rules_run, utc_now()
        self.counts = {r["severity"]: r["n"] for r in self.summary().collect()}

    def _order(self) -> list[Column]:
        """Most severe first, then by rule id as text and design."""
        rank = F.when(F.col("severity") == BLOCK, -RANK[BLOCK]).when(F.col("severity") == WARN, -RANK[WARN]).otherwise(-RANK[INFO])
        return [rank, F.col("rule_id"), F.coalesce("design_id", F.lit("")), F.coalesce("message", F.lit("")), F.coalesce("artifact", F.lit(""))]

    def sorted(self) -> DataFrame:
        """The findings in the report's order."""
        return self.findings.orderBy(*self._order())

    def placed(self) -> DataFrame:
        """The findings with their ``place`` in the report, from 1, without a global sort in one task; findings alike in all share places."""
        counted = self.findings.groupBy(*self.findings.columns).agg(F.count("*").alias("_n")).withColumn("_order", F.struct(*[c.alias(f"o{i}") for i, c in enumerate(self._order())], F.coalesce("expected", F.lit("")).alias("e"), F.coalesce("actual", F.lit("")).alias("a")))
        upto = stats.cumulate(counted, F.col("_order"), {"_upto": "_n"})
        return upto.withColumn("place", F.explode(F.sequence(F.col("_upto") - F.col("_n") + 1, F.col("_upto")))).drop("_n", "_order", "_upto")

    def summary(self) -> DataFrame:
        """(severity, n) of all three severities."""
        rows = F.array(*[F.struct(F.lit(s).alias("severity"), F.count(F.when(F.col("severity") == s, True)).alias("n")) for s in (BLOCK, WARN, INFO)])
        return self.findings.agg(rows.alias("r")).select(F.explode("r").alias("r")).select("r.*")

    def worst(self) -> str | None:
        return next((s for s in (BLOCK, WARN, INFO) if self.counts[s]), None)

    def exit_code(self, fail_on: str = "block") -> int:
        """1 if anything reaches ``fail_on``; ``none`` never fails and any word but block and none means warn."""
        if fail_on == "none":
            return 0
        return int(bool(self.counts[BLOCK] or (fail_on != "block" and self.counts[WARN])))

    def head(self, most: int = HEAD) -> list:
        """The first findings in order, ``most`` at most."""
        return self.sorted().limit(most).collect()

    @property
    def total(self) -> int:
        return sum(self.counts.values())

    def to_dict(self, most: int = HEAD) -> dict:
        """Counts and the first findings; ``left_out`` tells how many more there are."""
        rows = [{k: v for k, v in r.asDict().items() if v is not None} for r in self.head(most)]
        out = {"target_id": self.target_id, "generated_at": self.generated_at, "rules_run": self.rules_run, "counts": self.counts, "findings": rows}
        return out | ({"left_out": self.total - len(rows)} if len(rows) < self.total else {})

    def render(self, fail_on: str = "block", most: int = HEAD) -> str:
        """Markdown of the counts and the first findings."""
        c = self.counts
        out = [
            f"# Audit of {self.target_id}", "", f"- generated: {self.generated_at}", f"- rules: {', '.join(self.rules_run) or '(none)'}",
            f"- verdict: **{'blocked' if self.exit_code(fail_on) else 'passed'}** (fail-on={fail_on})",
            f"- counts: BLOCK {c[BLOCK]}, WARN {c[WARN]}, INFO {c[INFO]}", "",
        ]
        titles, before, rows = {BLOCK: "To be mended (stops the export)", WARN: "To be looked at", INFO: "Notes and skipped checks"}, None, self.head(most)
        for r in rows:
            if r["severity"] != before:
                before = r["severity"]
                out += [f"## {titles[before]} ({c[before]})", ""]
            out.append(f"- **{r['rule_id']}** `{r['design_id'] or r['artifact'] or '-'}`: {r['message']}")
            if r["expected"] is not None or r["actual"] is not None:
                out.append(f"  - expected: `{r['expected']}`, actual: `{r['actual']}`")
        if before is None:
            out.append("Nothing found.")
        if len(rows) < self.total:
            out += ["", f"{self.total - len(rows)} more findings are in `findings/`."]
        return "\n".join(out) + "\n"

    def write_lines(self, folder: str) -> None:
        """All findings in order as JSON lines without what is null, by the executors."""
        self.sorted().write.mode("overwrite").json(folder)

    def write(self, folder: str | Path, fail_on: str = "block") -> None:
        """The report, its JSON, and if these leave findings out all of them as JSON lines, written by the executors."""
        folder = str(folder).rstrip("/")
        system, path = open_uri(folder)
        system.create_dir(path)
        if self.total > HEAD:
            self.write_lines(f"{folder}/findings")
        write_text(f"{folder}/review_report.md", self.render(fail_on))
        write_text(f"{folder}/review_findings.json", json.dumps(self.to_dict(), ensure_ascii=False, indent=2))


def artifacts_summary(ctx: Context) -> dict:
    """What a semantic reviewer is shown: ids, counts and places, no contents."""
    uris = ctx.designs.where("manifest_uri is not null").select("manifest_uri").distinct()
    return {
        "target_id": ctx.target_id, "n_records": ctx.designs.count(), "runs": [r["run_id"] for r in ctx.runs.select("run_id").toLocalIterator()],
        "submission_dir": ctx.package, "manifest_uris": [r["manifest_uri"] for r in uris.toLocalIterator()],
    }


def run_review(ctx: Context, semantic: Callable[[dict], list[dict]] | None = None, rules=RULES) -> Report:
    """Run all rules that apply; one that fails becomes an INFO finding and hides no other."""
    if ctx.designs.isEmpty() and ctx.runs.isEmpty():
        return Report(ctx.target_id, note(ctx, "-", INFO, "no record of this target, nothing to audit"), [])
    parts, run = [], []
    for rule, _, plan, export_only in rules:
        if export_only and ctx.scope != "export" and ctx.package is None:
            continue
        run.append(rule)
        try:
            parts.append(materialize(plan(ctx), f"findings-{rule}"))
        except Exception as error:  # noqa: BLE001
            parts.append(note(ctx, rule, INFO, f"the rule failed and says nothing: {str(error)[:300]}"))
    if semantic is not None:
        try:
            told = semantic(artifacts_summary(ctx))
            rows = [(str(f.get("rule_id") or "R-SEM"), INFO, *[f.get(k) for k in schema.FINDINGS.names[2:]]) for f in told]
            parts.append(ctx.spark.createDataFrame(rows, schema.FINDINGS))
        except Exception as error:  # noqa: BLE001
            parts.append(note(ctx, "R-SEM", INFO, f"the semantic reviewer failed: {str(error)[:300]}"))
    return Report(ctx.target_id, union(parts), run)


def http_reviewer(endpoint: str, timeout: float = 30.0) -> Callable[[dict], list[dict]]:
    """A reviewer behind an HTTP endpoint: the summary is posted as JSON, findings come back."""

    def review(summary: dict) -> list[dict]:
        from urllib.request import Request, urlopen

        request = Request(endpoint, json.dumps(summary).encode(), {"Content-Type": "application/json"})
        with urlopen(request, timeout=timeout) as answer:
            return json.loads(answer.read().decode()).get("findings", [])

    return review
