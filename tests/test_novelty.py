"""Fewest edits, greatest identity and exact copies against brute force."""

import random
import time

import pytest
from pyspark.sql import functions as F

from sievework.cli import main
from sievework.operators import novelty
from sievework.sources.registry import Registry
from tests.cases import TARGET, make

LETTERS = "ACDEFGHIKLMNPQRSTVWY"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def edited(rng, text, edits, letters=LETTERS):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out) + 1)
        kind = rng.randint(0, 2)
        if kind == 0 or not out:
            out.insert(at, rng.choice(letters))
        elif kind == 1:
            del out[min(at, len(out) - 1)]
        else:
            out[min(at, len(out) - 1)] = rng.choice(letters)
    return "".join(out)


def sequences(spark, rows):
    return spark.createDataFrame([(r, "x") for r in rows], "sequence string, edits string")


@pytest.mark.parametrize("letters", [LETTERS, "AC"])
def test_edits_and_identity_equal_brute_force(spark, letters):
    rng = random.Random(len(letters))
    made = lambda n: "".join(rng.choice(letters) for _ in range(n))
    known = [made(rng.choice([3, 9, 20, 40, 80])) for _ in range(40)] + ["", "A", None]
    designs = [edited(rng, rng.choice(known[:40]), rng.randint(0, 12), letters) for _ in range(120)] + [known[0], known[0], "", None, made(200)]
    left, right = {d for d in designs if d is not None}, {k for k in known if k is not None}
    for least in (0, 1, 4, 10):
        want = {d: m for d in left if (m := min(distance(d, k) for k in right)) < least}
        assert {r["sequence"]: r["mutations"] for r in novelty.fewest_mutations(sequences(spark, designs), sequences(spark, known), least).collect()} == want
    for most in (0.7, 0.9, 1.0):
        near = {d: max(1 - distance(d, k) / max(len(d), len(k), 1) for k in right) for d in left}
        got = {r["sequence"]: r["identity"] for r in novelty.greatest_identity(sequences(spark, designs), sequences(spark, known), most).collect()}
        assert got == pytest.approx({d: i for d, i in near.items() if i >= most})
    assert novelty.fewest_mutations(sequences(spark, []), sequences(spark, known), 4).isEmpty() and novelty.fewest_mutations(sequences(spark, designs), sequences(spark, []), 4).isEmpty()


def test_filter_command_measures_novelty(spark, tmp_path, monkeypatch):
    c = make(spark, tmp_path)
    monkeypatch.chdir(c.root)
    one, two, three, four = (r["sequence"] for r in c.rows)
    fasta = lambda name, *rows: (tmp_path / name).write_text("".join(f">x\n{r}\n" for r in rows)) and str(tmp_path / name)
    profile = tmp_path / "novel.yaml"
    profile.write_text(c.profile.read_text() + "novelty: {min_mutations_vs_known_binders: 3, max_identity_vs_pdb: 0.9}\npeptide_specific: {disallow_exact_duplicate_of: [earlier]}\n")
    near = fasta("known.fasta", one[:-2] + "W", "ACACAC")
    args = ["filter", "--target", str(c.target), "--db", c.registry.path, "--profile", str(profile), "--known", near, "--pdb", fasta("pdb.fasta", two), "--lists", f"earlier={fasta('e.fasta', three)},other={fasta('o.fasta', four)}"]
    assert main(args, spark) == 0
    flags = {r["sequence"]: r["liability_flags"] for r in Registry(spark, c.registry.path).query_target(TARGET).collect()}
    gates = {s: [w for w in ("few_mutations", "known_structure", "copy_of_earlier", "copy_of_other") if f"gate:{w}" in (flags[s] or "")] for s in flags}
    assert gates == {one: ["few_mutations"], two: ["known_structure"], three: ["copy_of_earlier"], four: []}


def test_measured_keeps_other_metrics_and_abstains_without_references(spark, tmp_path):
    from sievework.sources.registry import decode

    rows = decode(make(spark, tmp_path).registry.read())
    profile = {"novelty": {"min_mutations_vs_known_binders": 5, "max_identity_vs_pdb": 0.9}}
    assert rows.columns == novelty.measured(rows, profile).columns[:-1] and novelty.measured(rows, profile).where(F.size("copy_of") > 0).isEmpty()
    told = novelty.measured(rows, profile, known=sequences(spark, ["W" * 60])).select("metrics").collect()
    assert all(r["metrics"] == {"iptm": 0.9, "hbonds": 4.0, "mutations_vs_known": 5.0} for r in told)


def test_designs_that_share_most_of_their_residues_are_not_listed_pair_by_pair(spark):
    """Names that differ in their numbers only: 36 million pairs, all of which share two of three pieces."""
    rows = spark.range(15000).select(F.format_string("Customer#%09d", "id").alias("sequence"), "id")
    began = time.monotonic()
    got = {r["sequence"]: r["mutations"] for r in novelty.fewest_mutations(rows.where("id % 5 > 0"), rows.where("id % 5 = 0"), 3).collect()}
    assert time.monotonic() - began < 60
    assert got == {f"Customer#{i:09d}": 1 for i in range(15000) if i % 5}


def test_short_designs_meet_no_tree_within_two_edits(spark, monkeypatch):
    """All ways of one and two edits against brute force, both measures; trees are for what is longer or farther."""
    rng = random.Random(5)
    left, right = ([("".join(rng.choices("ab", k=rng.randint(0, 7)))) for _ in range(60)] for _ in range(2))
    met = []
    trees = novelty._by_trees
    monkeypatch.setattr(novelty, "_by_trees", lambda open_, *rest: met.extend(r["n"] for r in open_.collect()) or trees(open_, *rest))
    near = {d: min(distance(d, k) for k in set(right[:6])) for d in left}
    got = novelty.fewest_mutations(sequences(spark, left), sequences(spark, right[:6]), 3).collect()
    assert {r["sequence"]: r["mutations"] for r in got} == {d: n for d, n in near.items() if n <= 2} and len(set(near.values())) > 2
    like = {d: max(1 - distance(d, k) / max(len(d), len(k), 1) for k in right) for d in left}
    got = {r["sequence"]: r["identity"] for r in novelty.greatest_identity(sequences(spark, left), sequences(spark, right), 0.7).collect()}
    assert got == pytest.approx({d: i for d, i in like.items() if i >= 0.7})
    assert not met


def test_keys_and_results_are_not_broadcast(spark, monkeypatch):
    """Compressed files and rows before explode() say little of a join's size: no side of it may be sent to the driver."""
    plans, keep = [], novelty.materialize
    monkeypatch.setattr(novelty, "materialize", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df, label))
    rows = spark.range(400).select(F.format_string("Customer#%09d", "id").alias("sequence"), "id")
    got = novelty.fewest_mutations(rows.where("id % 5 > 0"), rows.where("id % 5 = 0"), 3)
    assert got.count() == 320 and any("LeftSemi" in p for p in plans)
    profile = {"novelty": {"min_mutations_vs_known_binders": 3, "max_identity_vs_pdb": 0.9}, "peptide_specific": {"disallow_exact_duplicate_of": ["earlier"]}}
    designs, known = rows.select("sequence", F.create_map(F.lit("iptm"), F.lit(0.9)).alias("metrics")), rows.where("id % 5 = 0")
    told = novelty.measured(designs, profile, known=known, pdb=known, lists={"earlier": known})
    plans.append(told._jdf.queryExecution().executedPlan().toString())
    assert not any("Broadcast" in p for p in plans) and told.where("size(copy_of) = 1").count() == 80
