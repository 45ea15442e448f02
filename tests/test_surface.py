"""Buried surface on analytic spheres, hydrogen bonds against a pair loop."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sievework.operators import surface
from sievework.sources import files

ATOMS = "structure string, side string, atom long, element string, x double, y double, z double"


def test_areas_of_analytic_spheres(spark):
    one, two = 1.70 + 1.4, 1.52 + 1.4
    far = 4.0
    rows = [("single", "A", 1, "C", 5.0, 5.0, 5.0), ("pair", "A", 1, "C", -0.5, 15.9, 3.0), ("pair", "B", 2, "O", -0.5 + far, 15.9, 3.0)]
    rows += [("same", "A", 1, "C", 0.0, 0.0, 0.0), ("same", "A", 2, "O", far, 0.0, 0.0), ("apart", "A", 1, "C", 0.0, 0.0, 0.0), ("apart", "B", 2, "O", 50.0, 0.0, 0.0)]
    rows += [("odd", "A", 1, "C", float("nan"), 0.0, 0.0), ("odd", None, 2, "C", 0.0, 0.0, 0.0), (None, "A", 3, "C", 0.0, 0.0, 0.0)]
    got = {r["structure"]: r for r in surface.buried_surface(spark.createDataFrame(rows, ATOMS), points=4000).collect()}
    ball = lambda r: 4 * math.pi * r * r
    cap = lambda r, other: 2 * math.pi * r * (r - (far**2 + r**2 - other**2) / (2 * far))
    caps = cap(one, two) + cap(two, one)
    assert got.keys() == {"single", "pair", "same", "apart"}
    assert got["single"]["exposed"] == pytest.approx(ball(one)) and got["single"]["buried"] == 0
    assert got["pair"]["buried"] == pytest.approx(caps, rel=0.01) and got["pair"]["exposed"] == pytest.approx(ball(one) + ball(two) - caps, rel=0.01)
    assert got["same"]["buried"] == 0 and got["same"]["exposed"] == pytest.approx(got["pair"]["exposed"], rel=0.01)
    assert got["apart"]["buried"] == 0


def test_areas_over_many_blocks_equal_one_block(spark):
    rng = np.random.default_rng(5)
    places = rng.uniform(-25, 25, (300, 3))
    elements, sides = rng.choice(["C", "N", "O", "S", "ZN"], 300), rng.choice(["A", "B", "C"], 300)
    rows = [("s", str(sides[i]), i, str(elements[i]), *map(float, places[i])) for i in range(300)]
    reach = np.array([surface.RADII.get(e, surface.OTHER_RADIUS) + surface.PROBE for e in elements])
    whole, alone = surface.exposed(places, reach, sides, np.arange(300), surface.sphere())
    got = {r["atom"]: (r["whole"], r["alone"]) for r in surface.areas(spark.createDataFrame(rows, ATOMS)).collect()}
    assert len(got) == 300 and all(got[i] == pytest.approx((whole[i], alone[i])) for i in range(300))
    assert surface.areas(spark.createDataFrame([], ATOMS)).isEmpty()
    named = spark.createDataFrame(rows, ATOMS).withColumns({"residue_no": (F.col("atom") % 30).cast("string"), "residue": F.lit("GLY")})
    residues = {(r["side"], r["residue_no"]): r["buried"] for r in surface.interface_residues(named).collect()}
    want = {}
    for i in range(300):
        if alone[i] > whole[i]:
            key = (str(sides[i]), str(i % 30))
            want[key] = want.get(key, 0.0) + alone[i] - whole[i]
    assert residues == pytest.approx(want) and len(want) > 10


def plain_bonds(rows, within, least):
    """Bonds by looking at all pairs of atoms."""
    gap = lambda p, q: math.dist(p[6:], q[6:])

    def gives(a):
        return a[5] == "N" and a[4] != "PRO" or a[5] in surface.DONORS.get(a[4], ())

    def takes(a):
        return a[5] in ("O", "OXT") or a[5] in surface.ACCEPTORS.get(a[4], ())

    def wide(a, other):
        bound = [b for b in rows if b[:2] == a[:2] and b[3] == a[3] and b[2] != a[2] and gap(a, b) <= surface.BOND]
        if not bound:
            return True
        b = min(bound, key=lambda b: (gap(a, b), b[2]))
        u, v = (np.array(p[6:]) - np.array(a[6:]) for p in (b, other))
        return math.degrees(math.acos(np.clip(u @ v / np.linalg.norm(u) / np.linalg.norm(v), -1, 1))) >= least

    return {(a[0], a[2], b[2]) for a in rows for b in rows if a[0] == b[0] and a[1] != b[1] and gives(a) and takes(b) and gap(a, b) <= within and wide(a, b) and wide(b, a)}


def test_hydrogen_bonds_equal_a_pair_loop(spark):
    rng = random.Random(11)
    names = {r: ("N", "CA", "C", "O", *surface.DONORS.get(r, ()), *surface.ACCEPTORS.get(r, ())) for r in ("ARG", "ASP", "SER", "PRO", "GLY", "HIS", "TYR")}
    rows, atom = [], 0
    for structure in ("s", "t"):
        for number in range(40):
            residue, centre = rng.choice(list(names)), [rng.uniform(0, 12) for _ in range(3)]
            for name in dict.fromkeys(names[residue]):
                atom += 1
                rows.append((structure, "AB"[number % 2], atom, str(number // 2), residue, name, *[c + rng.uniform(-1.2, 1.2) for c in centre]))
    frame = spark.createDataFrame(rows, "structure string, side string, atom long, residue_no string, residue string, name string, x double, y double, z double")
    for within, least in ((3.5, 90.0), (5.0, 120.0), (3.0, 0.0)):
        got = surface.hydrogen_bonds(frame, within, least).collect()
        assert {(r["structure"], r["donor"], r["acceptor"]) for r in got} == plain_bonds(rows, within, least) and len(got) == len({tuple(r)[:3] for r in got})
    assert len(plain_bonds(rows, 3.5, 90.0)) > 10 and surface.hydrogen_bonds(frame.where("false")).isEmpty()


def test_atoms_of_pdb_files(spark, tmp_path):
    line = "ATOM      1  OG ASER B  12A   {:8.3f}   2.000  -3.500  1.00  0.00           O\n"
    (tmp_path / "x.pdb").write_text("HEADER\n" + line.format(1.5) + "ATOM      2  N   GLY A   1    broken\nHETATM    3  O   HOH W   1       0.000   0.000   0.000\nENDMDL\n" + line.format(9))
    got = files.atoms(spark.createDataFrame([("x.pdb",), ("gone.pdb",)], "path string"), [str(tmp_path)])
    assert [tuple(r) for r in got.collect()] == [("x.pdb", 1, "B", "12A", "SER", "OG", "O", 1.5, 2.0, -3.5)]
    assert got.select(F.round(surface.radius(F.col("element")), 2)).first()[0] == 1.52


def test_small_blocks_are_met_together_and_those_cut_by_a_batch_are_whole(monkeypatch):
    rng, points = np.random.default_rng(8), surface.sphere()
    n = 120
    key = np.sort(rng.integers(0, 25, n))
    rows = pa.table({"structure": key, "side": rng.choice(["A", "B"], n), "atom": np.arange(n), "reach": rng.uniform(2.5, 3.2, n), **{c: rng.uniform(0, 6, n) for c in "xyz"}, "own": rng.random(n) < 0.8, **{b: np.zeros(n, int) for b in ("bx", "by", "bz")}})
    monkeypatch.setattr(surface, "ROWS", 10)
    monkeypatch.setattr(surface, "TESTED", 7)
    got = pa.Table.from_batches(surface._blocks(points)(iter(rows.to_batches(max_chunksize=3)))).to_pylist()
    at = np.stack([rows[c].to_numpy() for c in "xyz"], axis=1)
    reach, side, own = rows["reach"].to_numpy(), np.array(rows["side"].to_pylist()), rows["own"].to_pylist()
    want = {}
    for i in np.flatnonzero(own):
        on = at[i] + reach[i] * points
        covers = lambda j: ((on - at[j]) ** 2).sum(1) < reach[j] ** 2  # noqa: B023, E731
        others = [j for j in range(n) if j != i and key[j] == key[i]]
        free = [~np.any([covers(j) for j in js] or [np.zeros(len(points), bool)], axis=0) for js in (others, [j for j in others if side[j] == side[i]])]
        want[int(i)] = tuple(f.sum() * 4 * np.pi * reach[i] ** 2 / len(points) for f in free)
    assert {r["atom"]: (r["whole"], r["alone"]) for r in got} == {k: pytest.approx(v) for k, v in want.items()} and len(got) == len(want)
