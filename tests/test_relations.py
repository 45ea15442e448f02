"""Ancestry, hierarchical clusters and structures against plain loops."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sievework.operators import hierarchy, structures
from sievework.operators.ancestry import ancestry
from sievework.sources import files

# ancestry


def walk(parent):
    out = {}
    for node in parent:
        at, depth, seen = node, 0, {node}
        while parent[at] is not None and parent[at] in parent and parent[at] not in seen:
            at, depth = parent[at], depth + 1
            seen.add(at)
        if parent[at] is None or parent[at] not in parent:
            out[node] = (at, depth, "root" if parent[at] is None else "orphan")
        else:
            out[node] = (None, None, "cycle")
    return out


def found(spark, rows):
    return {r["id"]: (r["root"], r["depth"], r["ends"]) for r in ancestry(spark.createDataFrame(rows, "id long, parent long, root string"), "id", "parent").collect()}


def test_ancestry_equals_walking(spark):
    rng = random.Random(2)
    parent = {i: i - 1 if i else None for i in range(300)}  # a long chain
    parent |= {i: rng.choice([None, rng.randrange(400, 700), 5000 + i, rng.randrange(300)]) for i in range(400, 700)}  # trees, gaps, rings
    parent |= {800: 800, 801: 802, 802: 801, 803: 801}
    rows = [(k, v, "x") for k, v in parent.items()] + [(None, 3, "x"), (7, 6, "y"), (8, 900, "y")]
    rng.shuffle(rows)
    assert found(spark, rows) == walk(parent)
    assert found(spark, []) == {}


# hierarchical clusters


def plain_clusters(edges, items, cut):
    root = {i: i for i in items}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b, s in edges:
        if s is not None and s >= cut and a in root and b in root:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in items}


def kruskal(edges):
    root, total = {}, []

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for s, a, b in sorted(((-s, min(a, b), max(a, b)) for a, b, s in edges if s is not None and a != b)):
        if find(a) != find(b):
            root[find(b)] = find(a)
            total.append((a, b, -s))
    return total


@pytest.mark.parametrize("seed", [1, 2])
def test_forest_and_cuts_equal_kruskal(spark, seed):
    rng = random.Random(seed)
    items = list(range(120))
    edges = [(rng.randrange(100), rng.randrange(100), rng.choice([0.1, 0.2, 0.25, 0.5, 0.9]) if seed else rng.random()) for _ in range([60, 150, 900][seed])]
    edges += [(b, a, s) for a, b, s in edges[:20]] + [(1, 2, None), (3, 3, 0.9)]
    if seed == 1:
        edges += [(i, i + 1, 0.3) for i in range(100, 118)]  # a chain of ties
    pairs = spark.createDataFrame(edges, "a long, b long, similarity double")
    forest = hierarchy.spanning_forest(pairs)
    assert sorted(tuple(r) for r in forest.collect()) == sorted(kruskal(edges))
    cuts = [0.15, 0.3, 0.6]
    got = {(r["id"], r["cut"]): r["cluster"] for r in hierarchy.cut(forest, spark.createDataFrame([(i,) for i in items], "id long"), cuts).collect()}
    assert got == {(i, c): x for c in cuts for i, x in plain_clusters(edges, items, c).items()}


def test_clusters_without_edges(spark):
    none = spark.createDataFrame([], "a string, b string, similarity double")
    items = spark.createDataFrame([("x",), ("y",)], "id string")
    assert {(r["id"], r["cluster"]) for r in hierarchy.single_linkage(none, items, [0.5]).collect()} == {("x", "x"), ("y", "y")}
    assert hierarchy.single_linkage(none, items.where("false"), [0.5]).isEmpty()


# structures


def turned(rng, x, noise=0.0):
    q, _ = np.linalg.qr(rng.normal(size=(3, 3)))
    q[:, 0] *= np.sign(np.linalg.det(q))
    return x @ q + rng.normal(size=3) * 20 + rng.normal(size=x.shape) * noise


def chain(rng, n):
    steps = rng.normal(size=(n, 3))
    return np.cumsum(3.8 * steps / np.linalg.norm(steps, axis=1, keepdims=True), axis=0)


def plain_score(x, y, threshold):
    """One pair by plain loops over alignments, parts and rounds."""
    x, y = sorted((x, y), key=len)
    long, best = len(y), 0.0
    half = max(1.24 * (long - 15) ** (1 / 3) - 1.8, 0.5) if long > 21 else 0.5
    for shift in range(-len(x), long + 1):
        at = [(i, i + shift) for i in range(len(x)) if 0 <= i + shift < long]
        if len(at) < 5 or len(at) < threshold * long - 1e-9:
            continue
        p, q = np.array([x[i] for i, _ in at]), np.array([y[j] for _, j in at])
        n = len(at)
        for parts in (1, 2, 4):
            for k in range(parts):
                keep = list(range(n * k // parts, n * (k + 1) // parts))
                if len(keep) < min(5, n):
                    continue
                for _ in range(structures.REFINED):
                    a, b = p[keep], q[keep]
                    u, _, v = np.linalg.svd((a - a.mean(0)).T @ (b - b.mean(0)))
                    if np.linalg.det(u @ v) < 0:
                        u[:, 2] *= -1
                    far = [float(((row - a.mean(0)) @ u @ v + b.mean(0) - other) @ ((row - a.mean(0)) @ u @ v + b.mean(0) - other)) for row, other in zip(p, q, strict=True)]
                    best = max(best, sum(1 / (1 + d / half**2) for d in far) / long)
                    limit = max(max(half, 4.5) ** 2, sorted(far)[2])
                    keep = [i for i, d in enumerate(far) if d <= limit]
    return best


def test_score_of_moved_mirrored_and_longer_traces():
    rng = np.random.default_rng(1)
    x = chain(rng, 60)
    assert structures.tm_score(x, turned(rng, x)) == pytest.approx(1)
    assert structures.tm_score(x, -x) < 0.6  # the mirror image isn't a motion
    assert structures.tm_score(turned(rng, x[10:50]), x) == pytest.approx(40 / 60, abs=0.05)
    assert structures.tm_score(x[:30], x, 0.6) == 0
    assert structures.tm_score(x, turned(rng, x, 0.5)) > 0.8 > structures.tm_score(x, chain(rng, 60))
    hinge = np.vstack([x[:30], turned(rng, x[30:])])
    assert structures.tm_score(x, hinge) == pytest.approx(0.5, abs=0.12)


def test_structure_pairs_equal_plain_loops(spark):
    rng = np.random.default_rng(4)
    base = [chain(rng, n) for n in (12, 30, 40)]
    made = [turned(rng, b[s : len(b) - e], noise) for b in base for s, e, noise in ((0, 0, 0.0), (0, 0, 0.4), (2, 0, 0.3), (3, 5, 0.2), (0, 0, 2.0))]
    made += [chain(rng, int(n)) for n in rng.integers(5, 45, 10)]
    rows = [(f"d{i:02}", i % 2, [float(v) for v in x.ravel()], "t") for i, x in enumerate(made)]
    odd = [("null", 0, None, "t"), ("short", 0, [1.0] * 12, "t"), ("nan", 0, [float("nan")] * 36, "t"), ("hole", 0, [None] + [0.0] * 35, "t"), (None, 0, rows[0][2], "t"), ("nowhere", None, rows[0][2], "t")]
    traces = spark.createDataFrame(rows + odd, "id string, side int, xyz array<double>, tile string")
    for threshold, block in ((0.5, ()), (0.3, ("side",))):
        got = {(r["a"], r["b"]): r["similarity"] for r in structures.structure_pairs(traces if block else traces.where("side is not null"), threshold, block).collect()}
        want = {}
        for i, x in enumerate(made):
            for j in range(i):
                if (not block or (i - j) % 2 == 0) and (s := plain_score(made[j], x, threshold)) >= threshold:
                    want[f"d{j:02}", f"d{i:02}"] = s
        assert got.keys() == want.keys() and len(want) > 5
        assert all(math.isclose(got[k], want[k], abs_tol=1e-6) for k in want)


def test_structure_pairs_over_many_tiles(spark, monkeypatch):
    rng = np.random.default_rng(9)
    made = [turned(rng, b, 0.3) for b in (chain(rng, 20), chain(rng, 24)) for _ in range(12)]
    traces = spark.createDataFrame([(i, [float(v) for v in x.ravel()]) for i, x in enumerate(made)], "id long, xyz array<double>")
    whole = sorted(map(tuple, structures.structure_pairs(traces, 0.5).collect()))
    monkeypatch.setattr(structures, "TILE", 3)
    monkeypatch.setattr(structures, "BROADCAST_BANDS", 0)
    parts = sorted(map(tuple, structures.structure_pairs(traces, 0.5).collect()))
    assert [p[:2] for p in parts] == [p[:2] for p in whole] and len(whole) > 50
    assert structures.structure_pairs(traces.where("false"), 0.5).isEmpty()


def test_traces_of_pdb_files(spark, tmp_path):
    line = "ATOM  {:5d} {:<4} {} {}{:4d}    {:8.3f}{:8.3f}{:8.3f}  1.00  0.00           C\n"
    atoms = [(1, " N", "ALA", "A", 1), (2, " CA", "ALA", "A", 1), (3, " CA", "GLY", "B", 1), (4, " CB", "GLY", "B", 1), (5, " CA", "SER", "B", 2), (6, " CA", "SER", "B", 2)]
    (tmp_path / "x.pdb").write_text("".join(line.format(*a, a[0], a[0] / 2, -a[0]) for a in atoms) + "ENDMDL\n" + line.format(9, " CA", "TRP", "B", 3, 0, 0, 0))
    (tmp_path / "none.pdb").write_text("HEADER\n")
    (tmp_path / "x.cif").write_text("data")
    paths = spark.createDataFrame([("x.pdb",), ("none.pdb",), ("x.cif",), ("lost.pdb",), (None,)], "path string")
    got = {r["path"]: r["xyz"] for r in files.traces(paths, [str(tmp_path)]).collect()}
    assert got == {"x.pdb": [3.0, 1.5, -3.0, 5.0, 2.5, -5.0], "none.pdb": None, "x.cif": None, "lost.pdb": None}
    assert files.binder_sequence((tmp_path / "x.pdb").read_text()) == "GS"


def test_rings_are_told(spark, tmp_path):
    from sievework.plans.review import build_context, run_review
    from tests.cases import TARGET, make

    c = make(spark, tmp_path)
    a, b = c.rows[0], c.rows[1]
    c.registry.upsert_many([a | {"parent_id": b["design_id"]}, b | {"parent_id": a["design_id"]}])
    told = run_review(build_context(spark, c.registry, TARGET, target_path=c.target, profile_path=c.profile, repo_root=c.root)).findings
    assert {r["design_id"] for r in told.where(F.col("message").contains("ring")).collect()} >= {a["design_id"], b["design_id"]}


def test_superpositions_that_tell_nothing_new_are_not_made(monkeypatch):
    """Where all residues come near, the later fragments and rounds repeat the whole; results are those of singular values."""
    rng, made = np.random.default_rng(4), []
    x, y = (0.25 * rng.normal(size=(50, 21, 3)) for _ in range(2))
    once = structures.superpose
    monkeypatch.setattr(structures, "superpose", lambda p, q, w: (made.append(len(p)), once(p, q, w))[1])
    structures._best(x, y, 0.95)
    assert sum(made) <= 50 * 7 * len(structures.alignments(21, 21, 0.95))
    h = np.concatenate([rng.normal(size=(200, 3, 3)), rng.normal(size=(9, 3, 1)) * rng.normal(size=(9, 1, 3)), np.zeros((1, 3, 3)), np.eye(3)[None] * [[[1.0, 1, -1]]]])
    r = structures.rotations(h)
    s, sign = np.linalg.svd(h, compute_uv=False), np.sign(np.linalg.det(h))
    assert np.allclose(r @ r.transpose(0, 2, 1), np.eye(3)) and np.allclose(np.linalg.det(r), 1)
    assert np.allclose((r * h).sum((1, 2))[:200], (s[:, 0] + s[:, 1] + sign * s[:, 2])[:200]) and np.allclose((r * h).sum((1, 2))[200:], [*s[200:209, 0], 0, 1])


def test_pairs_of_small_structures_are_rated_at_once(spark, monkeypatch):
    """Where all residues come near, few superpositions are made in double precision, and the scores are those of all of them."""
    rng = np.random.default_rng(8)
    base = [0.3 * rng.normal(size=(21, 3)) for _ in range(4)]
    made = [turned(rng, b[: int(n)], 0.08) for b in base for n in (16, 20, 21) * 4]
    made += [np.outer(np.arange(21.0), [0.0, 0.05, 0.02]), np.zeros((21, 3)), made[0], -made[0], chain(rng, 21), chain(rng, 20)]  # on a line, in a point, copied, mirrored, large
    want = {}
    for i, x in enumerate(made):
        for j in range(i):
            if (s := structures.tm_score(made[j], x, 0.6)) >= 0.6:
                want[j, i] = s
    ends = np.cumsum([0, *[3 * len(x) for x in made]])
    rows = pa.table({"id": pa.array(range(len(made))), "xyz": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(made).ravel())), "mine": [True] * len(made), "own": [True] * len(made)})
    done, best, once, plain = [], structures._best, structures.superpose, []
    monkeypatch.setattr(structures, "superpose", lambda p, q, w: (done.append(len(p)), once(p, q, w))[1])
    monkeypatch.setattr(structures, "_best", lambda p, q, t: (plain.append(len(p)), best(p, q, t))[1])
    for rated in (structures.RATED, 50):
        monkeypatch.setattr(structures, "RATED", rated)
        monkeypatch.setattr(structures, "COLUMNS", rated)
        done.clear()
        plain.clear()
        got = {tuple(sorted(r[:2])): r[2] for r in zip(*(c.to_pylist() for c in structures._meet(0.6)(rows).columns), strict=True)}
        assert got == pytest.approx(want, abs=1e-12) and len(want) > 150
        assert sum(plain) < 2.1 * len(made) and sum(done) < 10 * len(made) ** 2  # of about 30 * len(made)**2
    own = np.arange(len(made)) % 2 == 0
    two = rows.set_column(2, "mine", pa.array(own)).set_column(3, "own", pa.array([False] * len(made)))
    got = {tuple(sorted(r[:2])): r[2] for r in zip(*(c.to_pylist() for c in structures._meet(0.6)(two).columns), strict=True)}
    assert got == pytest.approx({k: v for k, v in want.items() if own[k[0]] != own[k[1]]}, abs=1e-12)


def test_rotations_in_single_precision(monkeypatch):
    rng = np.random.default_rng(3)
    h = np.concatenate([rng.normal(size=(5000, 3, 3)), np.einsum("mki,mkj->mij", *rng.normal(size=(2, 5000, 5, 3))), rng.normal(size=(9, 3, 1)) * rng.normal(size=(9, 1, 3)), np.zeros((1, 3, 3)), np.eye(3)[None] * [[[1.0, 1, -1]]]])
    e = np.empty((5, 5, len(h)), np.float32)
    e[:3, :3] = h.transpose(1, 2, 0)
    r, shaky = structures._turns(e)
    assert np.abs(r.transpose(2, 0, 1) - structures.rotations(h))[~shaky].max() < 2e-4
    assert shaky[-11:].all() and shaky[:-11].mean() < 0.01
