"""Buried surface and hydrogen bonds of interfaces, on a grid of atoms.

Surface.  Every atom is a sphere of its radius and a probe's; points are
spread on it evenly, and those inside no other sphere are exposed.  Space is
cut into blocks; a block holds its own atoms and, from the blocks around it,
those near enough to cover one of its points, so a task holds what a few
nanometres hold, however large the structures and however many there are.
What the other side alone covers is the buried surface.

Hydrogen bonds.  A donor and an acceptor of different sides no farther apart
than a limit, found by the contacts' grid, whose angles at both ends, seen
from the atom each is bound to, are wide enough.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.operators.contacts import contacts

# Radii of elements in Angstrom, and of a water probe.
RADII = {"C": 1.70, "N": 1.55, "O": 1.52, "S": 1.80, "P": 1.80, "H": 1.10, "SE": 1.90}
OTHER_RADIUS, PROBE = 1.70, 1.40
# Side-chain atoms that give or take hydrogen; the chain's N gives (not that of PRO) and its O and OXT take.
DONORS = {"ARG": ("NE", "NH1", "NH2"), "ASN": ("ND2",), "GLN": ("NE2",), "HIS": ("ND1", "NE2"), "LYS": ("NZ",), "SER": ("OG",), "THR": ("OG1",), "TRP": ("NE1",), "TYR": ("OH",), "CYS": ("SG",)}
ACCEPTORS = {"ASN": ("OD1",), "ASP": ("OD1", "OD2"), "GLN": ("OE1",), "GLU": ("OE1", "OE2"), "HIS": ("ND1", "NE2"), "SER": ("OG",), "THR": ("OG1",), "TYR": ("OH",), "MET": ("SD",)}
#: Points on a sphere, and edge of a block in Angstrom.
POINTS, BLOCK = 96, 16.0
#: Rows of blocks, atoms, pairs of atoms, and near pairs that are met at once.
ROWS, OWN, PAIRS, TESTED = 8192, 4096, 200_000, 4096
#: Farthest that a bound atom may lie.
BOND = 2.1


def radius(element: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in RADII.items() for x in kv])
    return F.coalesce(F.try_element_at(known, F.upper(F.trim(element))), F.lit(OTHER_RADIUS))


def sphere(n: int = POINTS) -> np.ndarray:
    """``n`` points spread evenly on the unit sphere along a spiral."""
    i = np.arange(n) + 0.5
    z, turn = 1 - 2 * i / n, np.pi * (1 + 5**0.5) * i
    flat = np.sqrt(1 - z * z)
    return np.stack([flat * np.cos(turn), flat * np.sin(turn), z], axis=1)


def _exposed(places: np.ndarray, reach: np.ndarray, sides: np.ndarray, blocks: np.ndarray, own: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(area in the complex, area without the other sides) of the atoms ``own`` among all of their blocks, rows in the order of the blocks; ``reach`` is radius and probe."""
    bare = np.ones((2, len(own), len(points)), dtype=bool)
    starts, ends = np.searchsorted(blocks, blocks[own]), np.searchsorted(blocks, blocks[own], side="right")
    lo = 0
    while lo < len(own):
        hi = max(lo + 1, int(np.searchsorted(np.cumsum(ends[lo:] - starts[lo:]), PAIRS, side="right")) + lo)
        many = ends[lo:hi] - starts[lo:hi]
        mine = np.repeat(np.arange(lo, hi), many)
        other = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(starts[lo:hi], many)
        apart = places[own[mine]] - places[other]
        near = (np.sqrt((apart * apart).sum(1)) < reach[other] + reach[own[mine]]) & (other != own[mine])
        mine, other = mine[near], other[near]
        for at in range(0, len(mine), TESTED):
            i, j = mine[at : at + TESTED], other[at : at + TESTED]
            on = places[own[i]][:, None] + reach[own[i]][:, None, None] * points
            inside = ((on - places[j][:, None]) ** 2).sum(2) < (reach[j] ** 2)[:, None]
            same = sides[j] == sides[own[i]]
            for k, which in ((0, slice(None)), (1, same)):
                rows = i[which]
                if len(rows):
                    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])  # pairs of an atom follow each other
                    bare[k, rows[first]] &= ~np.logical_or.reduceat(inside[which], first, axis=0)
        lo = hi
    unit = 4 * math.pi * reach[own] ** 2 / len(points)
    return bare[0].sum(1) * unit, bare[1].sum(1) * unit


def exposed(places: np.ndarray, reach: np.ndarray, sides: np.ndarray, own: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(area in the complex, area without the other sides) of the atoms ``own`` among all, as one block."""
    return _exposed(places, reach, sides, np.zeros(len(places), dtype=np.int64), own, points)


def _areas(rows: pa.Table, points: np.ndarray) -> pa.Table:
    """Areas of the atoms that whole blocks own."""
    keys = [rows["structure"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False), *(rows[c].to_numpy() for c in ("bx", "by", "bz"))]
    new = np.r_[False, np.any([k[1:] != k[:-1] for k in keys], axis=0)] if rows.num_rows else np.zeros(0, bool)
    blocks = np.cumsum(new)
    places = np.stack([rows[c].to_numpy() for c in "xyz"], axis=1)
    sides = rows["side"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    own = np.flatnonzero(rows["own"].to_numpy(zero_copy_only=False))
    parts = [_exposed(places, rows["reach"].to_numpy(), sides, blocks, own[at : at + OWN], points) for at in range(0, len(own), OWN)] or [(np.zeros(0), np.zeros(0))]
    whole, alone = (np.concatenate(x) for x in zip(*parts, strict=True))
    kept = rows.select(["structure", "side", "atom"]).take(pa.array(own)).combine_chunks()
    return pa.table([*kept.columns, pa.array(whole), pa.array(alone)], ["structure", "side", "atom", "whole", "alone"])


def _blocks(points: np.ndarray):
    """For mapInArrow over rows in the order of their blocks: many small blocks are met at once; the last block waits for its other rows."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        size, due = 0, ROWS
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < due:
                continue
            rows = pa.Table.from_batches(held)
            last = np.ones(size, dtype=bool)
            for c in ("structure", "bx", "by", "bz"):
                last &= pc.equal(rows[c], rows[c][size - 1]).to_numpy()
            cut = size - int(last.sum())
            if cut:
                yield from _areas(rows.slice(0, cut), points).to_batches()
            held, size = rows.slice(cut).to_batches(), size - cut
            due = max(ROWS, 2 * size)
        if size:
            yield from _areas(pa.Table.from_batches(held), points).to_batches()

    return run


def areas(atoms: DataFrame, probe: float = PROBE, points: int = POINTS) -> DataFrame:
    """(structure, side, atom, whole, alone): exposed area of each atom in its structure, and without the other sides.

    Atoms are rows (structure, side, atom, element, x, y, z); those without a
    structure, a side or a finite place take no part.  Areas are in the
    square of the coordinates' unit.
    """
    fine = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < 1e9) for c in "xyz"]
    known = atoms.select("structure", "side", "atom", radius(F.col("element")).alias("r"), *[F.col(c).cast("double").alias(c) for c in "xyz"])
    known = known.where(F.col("structure").isNotNull() & F.col("side").isNotNull() & fine[0] & fine[1] & fine[2])
    most = max(*RADII.values(), OTHER_RADIUS) + probe
    # Blocks begin at a structure's least place, so that a small structure is one block.
    spans = known.groupBy("structure").agg(*[f(c).alias(f"{n}{c}") for c in "xyz" for f, n in ((F.min, "l"), (F.max, "u"))])
    cell = lambda at, c: F.floor((at - F.col(f"l{c}")) / BLOCK)
    around = lambda c: F.explode(F.sequence(F.greatest(cell(F.col(c) - 2 * most, c), F.lit(0)), F.least(cell(F.col(c) + 2 * most, c), cell(F.col(f"u{c}"), c))))
    dealt = known.join(spans, "structure").withColumn("reach", F.col("r") + probe).withColumns({f"h{c}": cell(F.col(c), c) for c in "xyz"})
    for c in "xyz":
        dealt = dealt.withColumn(f"b{c}", around(c))
    own = (F.col("bx") == F.col("hx")) & (F.col("by") == F.col("hy")) & (F.col("bz") == F.col("hz"))
    dealt = dealt.select("structure", "side", "atom", "reach", *"xyz", own.alias("own"), "bx", "by", "bz")
    kinds = {c: atoms.schema[c].dataType.simpleString() for c in ("structure", "side", "atom")}
    by = ("structure", "bx", "by", "bz")
    parts = int(atoms.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # told, so that few bytes of much work aren't put together
    return dealt.repartition(parts, *by).sortWithinPartitions(*by).mapInArrow(_blocks(sphere(points)), ", ".join(f"{c} {t}" for c, t in kinds.items()) + ", whole double, alone double")


def buried_surface(atoms: DataFrame, probe: float = PROBE, points: int = POINTS) -> DataFrame:
    """(structure, exposed, buried): area of each structure and what its sides cover of each other, both sides together."""
    found = areas(atoms, probe, points)
    return found.groupBy("structure").agg(F.sum("whole").alias("exposed"), F.sum(F.col("alone") - F.col("whole")).alias("buried"))


def interface_residues(atoms: DataFrame, probe: float = PROBE, points: int = POINTS) -> DataFrame:
    """(structure, side, residue_no, residue, buried) of the residues that another side covers in part."""
    named = atoms.select("structure", "side", "atom", "residue_no", "residue")
    found = areas(atoms, probe, points).where("alone > whole").join(named, ["structure", "side", "atom"])
    return found.groupBy("structure", "side", "residue_no", "residue").agg(F.sum(F.col("alone") - F.col("whole")).alias("buried"))


def _role(table: dict[str, tuple[str, ...]], chain: Column) -> Column:
    listed = F.array(*[F.lit(f"{residue} {name}") for residue, names in table.items() for name in names])
    return chain | F.array_contains(listed, F.concat_ws(" ", "residue", "name"))


def _angle(at: str, bound: str, other: str) -> Column:
    """Cosine of the angle at an atom between the atom it is bound to and another."""
    one, two = ([F.col(f"{p}{c}") - F.col(f"{at}{c}") for c in "xyz"] for p in (bound, other))
    dot, size = lambda a, b: sum((p * q for p, q in zip(a, b, strict=True)), F.lit(0.0)), lambda a: F.sqrt(sum((p * p for p in a), F.lit(0.0)))
    return F.try_divide(dot(one, two), size(one) * size(two))


def hydrogen_bonds(atoms: DataFrame, within: float = 3.5, least_angle: float = 90.0) -> DataFrame:
    """(structure, donor, acceptor, distance) between different sides; atoms are rows (structure, side, atom, residue_no, residue, name, x, y, z).

    Both angles must be ``least_angle`` degrees at least; an atom that is
    bound to none within its residue meets the condition at its end.
    """
    rows = atoms.select("structure", "side", "atom", "residue_no", F.upper("residue").alias("residue"), F.upper("name").alias("name"), "x", "y", "z")
    donor = _role(DONORS, (F.col("name") == "N") & (F.col("residue") != "PRO"))
    acceptor = _role(ACCEPTORS, F.col("name").isin("O", "OXT"))
    acting = rows.where(donor | acceptor).withColumns({"gives": donor, "takes": acceptor})
    beside = rows.select("structure", "side", "residue_no", F.col("atom").alias("o"), *[F.col(c).alias(f"o{c}") for c in "xyz"])
    gap = F.sqrt(sum(((F.col(c) - F.col(f"o{c}")) ** 2 for c in "xyz"), F.lit(0.0)))
    near = acting.join(beside, ["structure", "side", "residue_no"]).where((F.col("atom") != F.col("o")) & (gap <= BOND))  # atoms of one residue
    bound = near.groupBy("structure", "atom").agg(F.min(F.struct(gap.alias("gap"), "o", "ox", "oy", "oz")).alias("b")).select("structure", "atom", F.col("b.ox").alias("ox"), F.col("b.oy").alias("oy"), F.col("b.oz").alias("oz"))
    acting = acting.join(bound, ["structure", "atom"], "left")
    met = contacts(acting.where("gives"), acting.where("takes"), within)
    end = lambda p, key: acting.select("structure", F.col("atom").alias(key), F.col("side").alias(f"{p}side"), *[F.col(c).alias(f"{p}{c}") for c in "xyz"], *[F.col(f"o{c}").alias(f"{p}o{c}") for c in "xyz"])
    both = met.join(end("d", "a"), ["structure", "a"]).join(end("t", "b"), ["structure", "b"]).where("dside <> tside")
    limit = math.cos(math.radians(least_angle)) + 1e-12
    wide = [F.col(f"{p}ox").isNull() | (_angle(p, f"{p}o", q) <= limit) for p, q in (("d", "t"), ("t", "d"))]
    return both.where(wide[0] & wide[1]).select("structure", F.col("a").alias("donor"), F.col("b").alias("acceptor"), "distance")
