"""Similarity of structures: TM-score of CA traces by superposition.

Two traces are threaded along each other without gaps.  Each alignment is
superposed on fragments (the whole, halves, quarters) by quaternions, and
superposed again on the residues that came near, a few times; the best
score counts.  It is divided by the longer length, so it is symmetric and
never above the shorter length by the longer: pairs beyond that bound, and
alignments of too few residues, aren't tried.

Structures are dealt into bands of length, of which only equal and
neighbouring ones can pass the bound, and bands into tiles; two tiles meet in
a group of their own, and numpy works on all pairs of equal lengths in it at
once.

Where two structures are so small that all residues come near after any
superposition, none is superposed again.  All their superpositions are then
rated in single precision first, all pairs of two tiles at once, and only
those whose rating is within ``MARGIN`` of the pair's best and of the
threshold, or that single precision can't settle, are made in double
precision.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.plans.shared import materialize

#: Structures of a tile at least and at most, tiles of a band between these bounds; numbers that a batch of superpositions may hold.
TILE, MOST, SPREAD, HELD = 64, 512, 8, 200_000
#: Superpositions rated at once, columns of a step of them, pairs below which nothing is rated.
RATED, COLUMNS, FEW = 16_384, 1_024, 64
#: Laguerre's steps in single precision; least slope (an eighth of the quartic's) and greatest last step, by the slope, of a rotation that counts as settled.
STEPS, SLOPE, LAST = 5, 1e-2, 0.1
#: More than twice the error of a settled rating: rotations are off by 1e-4 at most, as measured on 400,000.
MARGIN = 2e-3
#: Times that a superposition is made again on the residues that came near.
REFINED = 6
#: Bands up to which the table of their sizes is broadcast; a shuffled join beyond.
BROADCAST_BANDS = 50_000
#: Partitions of the comparison at most.
PARTS = 2_048
#: Fewest residues of an alignment; distance within which a residue is near, if half a count isn't farther.
LEAST, NEAR = 5, 4.5


def scale(length: int) -> float:
    """Distance at which a residue counts half."""
    return max(1.24 * (length - 15) ** (1 / 3) - 1.8, 0.5) if length > 21 else 0.5


def alignments(short: int, long: int, threshold: float) -> list[tuple[int, int, int]]:
    """(start in the shorter, start in the longer, residues) of the gapless alignments that can reach the threshold."""
    least = max(math.ceil(threshold * long - 1e-9), LEAST)
    return [(max(0, -o), max(0, o), n) for o in range(least - short, long - least + 1) if (n := min(short + min(o, 0), long - max(o, 0))) >= least]


def fragments(n: int) -> list[tuple[int, int]]:
    """(start, end) of the parts of an alignment that are superposed first: whole, halves, quarters."""
    cuts = [(n * i // k, n * (i + 1) // k) for k in (1, 2, 4) for i in range(k)]
    return [c for c in dict.fromkeys(cuts) if c[1] - c[0] >= min(LEAST, n)]


def rotations(h: np.ndarray) -> np.ndarray:
    """The proper rotations r that make the trace of r' h largest, for moments h (m, 3, 3).

    Each is the quaternion of the largest root of Horn's symmetric matrix,
    found by Newton's steps from above and read off the matrix's adjugate;
    where that root nearly repeats, singular values are used.
    """
    size = np.sqrt((h * h).sum((1, 2)))
    s = h / np.where(size > 0, size, 1)[:, None, None]
    n = np.empty((len(h), 4, 4))
    n[:, 0, 0] = s[:, 0, 0] + s[:, 1, 1] + s[:, 2, 2]
    for k, (i, j) in enumerate(((1, 2), (2, 0), (0, 1)), 1):
        n[:, 0, k] = n[:, k, 0] = s[:, i, j] - s[:, j, i]
        n[:, k, k] = 2 * s[:, k - 1, k - 1] - n[:, 0, 0]
        a, b = sorted((i + 1, j + 1))
        n[:, a, b] = n[:, b, a] = s[:, i, j] + s[:, j, i]
    square = n @ n
    two, three, four = 4 * (s * s).sum((1, 2)), (square * n).sum((1, 2)), (square * square).sum((1, 2))
    c2, c1, c0 = -two / 2, -three / 3, (two * two / 2 - four) / 4
    root = np.full(len(h), 3**0.5)
    for _ in range(14):
        slope = (4 * root * root + 2 * c2) * root + c1
        root -= (((root * root + c2) * root + c1) * root + c0) / np.where(slope > 1e-9, slope, 1)
    slope = (4 * root * root + 2 * c2) * root + c1
    shift = np.eye(4)
    adjugate = square @ (n + root[:, None, None] * shift) + (root * root + c2)[:, None, None] * n + ((root * root + c2) * root + c1)[:, None, None] * shift
    at = np.abs(np.einsum("mii->mi", adjugate)).argmax(1)
    q = adjugate[np.arange(len(h)), at]
    w, x, y, z = (q / np.maximum(np.sqrt((q * q).sum(1)), 1e-300)[:, None]).T
    out = np.stack([1 - 2 * (y * y + z * z), 2 * (x * y + w * z), 2 * (x * z - w * y), 2 * (x * y - w * z), 1 - 2 * (x * x + z * z), 2 * (y * z + w * x), 2 * (x * z + w * y), 2 * (y * z - w * x), 1 - 2 * (x * x + y * y)], axis=1).reshape(-1, 3, 3)
    if (poor := np.flatnonzero(~(slope > 1e-3))).size:
        u, _, vt = np.linalg.svd(h[poor])
        u[:, :, 2] *= np.sign(np.linalg.det(u @ vt))[:, None]
        out[poor] = u @ vt
    return out


def superpose(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Squared distances of points after the best rigid motion of x (m, n, 3) onto y by weights (m, n)."""
    total = w.sum(1)[:, None, None]
    cx, cy = w[:, None] @ x / total, w[:, None] @ y / total
    x, y = x - cx, y - cy
    gap = x @ rotations((w[:, :, None] * x).transpose(0, 2, 1) @ y) - y
    return np.einsum("mni,mni->mn", gap, gap)


def _best(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Scores of pairs of traces x (p, short, 3) and y (p, long, 3)."""
    short, long = x.shape[1], y.shape[1]
    half, best = scale(long), np.zeros(len(x))
    for i, j, n in alignments(short, long, threshold):
        parts = fragments(n)
        first = np.zeros((len(parts), n))
        for k, (a, b) in enumerate(parts):
            first[k, a:b] = 1
        step = max(1, HELD // (len(parts) * n * 3))
        for at in range(0, len(x), step):
            p, q = x[at : at + step, i : i + n], y[at : at + step, j : j + n]
            p, q = np.repeat(p, len(parts), 0), np.repeat(q, len(parts), 0)
            w = np.tile(first, (len(p) // len(parts), 1))
            pair, whole = np.repeat(np.arange(at, min(at + step, len(x))), len(parts)), first[0].all()
            for _ in range(REFINED):
                far = superpose(p, q, w)
                np.maximum.at(best, pair, (1 / (1 + far / half**2)).sum(1) / long)
                third = np.partition(far, 2, axis=1)[:, 2:3]
                new = (far <= np.maximum(max(half, NEAR) ** 2, third)).astype(np.float64)
                # What is superposed on the same residues again, or on all, as the first fragment was, tells nothing new.
                go = (new != w).any(1) & ~(new.all(1) & whole)
                if not go.any():
                    break
                p, q, w, pair = p[go], q[go], new[go], pair[go]
    return best


def _turns(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``rotations`` in single precision of the moments e[:3, :3] (5, 5, m), which are overwritten, as (3, 3, m), and which of them aren't settled.

    With the moments h = r u, u symmetric of invariants i1 (the quartic's
    largest root), i2 and i3, and the cofactors c of h, it holds that
    (i1 i2 - i3) r = i1 c + (i1² - i2) h - h h' h.
    """
    s = e[:3, :3]
    s *= 1 / np.maximum(np.sqrt(np.add.reduce(np.square(s).reshape(9, -1), axis=0)), np.float32(1e-12))
    e[3:, :3], e[:, 3:] = e[:2, :3], e[:, :2]
    r = e[1:4, 1:4] * e[2:5, 2:5]
    r -= e[1:4, 2:5] * e[2:5, 1:4]
    i3 = np.add.reduce(e[0, :3] * r[0], axis=0)
    c0, c1, i1 = 1 - 4 * np.add.reduce(np.square(r).reshape(9, -1), axis=0), -8 * i3, np.full_like(i3, 3**0.5)
    for _ in range(STEPS):
        t = np.square(i1)
        value = t - 2
        value *= t
        value += c0
        value += c1 * i1
        slope = t - 1
        slope *= i1
        slope *= 4
        slope += c1
        t *= 144
        t -= 48
        t *= value
        under = np.square(slope)
        under *= 9
        under -= t
        slope += np.sqrt(np.maximum(under, 0, out=under), out=under)
        value /= np.maximum(slope, np.float32(1e-4), out=slope)
        value *= 4
        i1 -= value
    i2 = (np.square(i1) - 1) / 2
    d = i1 * i2 - i3
    h = s[0][:, None] * s[0][None]
    for a in (1, 2):
        h += s[a][:, None] * s[a][None]
    np.negative(h, out=h)
    for a in range(3):
        h[a, a] += np.square(i1) - i2
    r *= i1
    for a in range(3):
        r += s[:, a][:, None] * h[a][None]
    r *= 1 / np.maximum(d, np.float32(1e-6))
    return r, (d < SLOPE) | (np.abs(value) > LAST * d)


def _rated(x: np.ndarray, y: np.ndarray, tried: list[tuple[int, ...]], half: float) -> np.ndarray:
    """Scores (superposition, left, right) in single precision of all pairs of x (3, left, short) and y (3, long, right), infinite if not settled."""
    many, wide = x.shape[1], y.shape[2]
    out, e, step = np.empty((len(tried), many, wide), np.float32), np.empty((5, 5, many * wide), np.float32), max(1, COLUMNS // wide)
    for k, (i, j, n, a, b) in enumerate(tried):
        p, q = x[:, :, i : i + n], y[:, j : j + n]
        p, q = p - p[:, :, a:b].mean(2, keepdims=True), q - q[:, a:b].mean(1, keepdims=True)
        e[:3, :3] = np.matmul(p[:, None, :, a:b], q[None, :, a:b]).reshape(3, 3, -1)
        r, shaky = _turns(e)
        r = r.reshape(3, 3, many, wide)
        left, right, turned = np.square(p).sum(0) + 1, np.square(q).sum(0), -2 * p.transpose(1, 2, 0)
        for at in range(0, many, step):
            v = np.matmul(turned[at : at + step, None], r[:, :, at : at + step].transpose(2, 1, 0, 3))
            v *= q
            far = v[:, 0]
            far += v[:, 1]
            far += v[:, 2]
            far += right
            far += left[at : at + step, :, None]
            np.add.reduce(np.reciprocal(far, out=far), axis=1, out=out[k, at : at + step])
        out[k][shaky.reshape(many, wide)] = np.inf
    return out


def _small(x: np.ndarray, limit: float) -> np.ndarray:
    """Which structures (m, n, 3) have no two residues farther apart than the limit."""
    small = np.square(x - x.mean(1, keepdims=True)).sum(2).max(1) <= limit**2  # the mean is nearer than the farthest residue
    for k in range(x.shape[1]):
        some = np.flatnonzero(small)
        small[some] = np.square(x[some] - x[some, k : k + 1]).sum(2).max(1) <= limit**2
    return small


def _best_of_small(x: np.ndarray, y: np.ndarray, threshold: float, own: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, score) of the pairs of small structures x (p, short, 3) and y (q, long, 3) that may reach the threshold; of the same ones only left < right."""
    short, long = x.shape[1], y.shape[1]
    half = scale(long)
    tried = [(i, j, n, a, b) for i, j, n in alignments(short, long, threshold) for a, b in fragments(n)]
    xs, ys = (((z - z.mean(1, keepdims=True)) / half).astype(np.float32) for z in (x, y))
    xs, ys, found = np.ascontiguousarray(xs.transpose(2, 0, 1)), np.ascontiguousarray(ys.transpose(2, 1, 0)), []
    step = max(1, min(RATED // len(y), len(x) // 4 if own else len(x)))  # steps of the same ones leave out what lies before them
    for at in range(0, len(x), step):
        first = at + 1 if own else 0
        for lo in range(first, len(y), RATED):
            score = _rated(xs[:, at : at + step], np.ascontiguousarray(ys[:, :, lo : lo + RATED]), tried, half) / long
            settled = np.isfinite(score)
            cut = np.maximum(np.where(settled, score, 0).max(0), threshold) - MARGIN
            k, i, j = np.nonzero(score >= cut)
            found.append((k, i + at, j + lo))
    k, i, j = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.empty(0, int),) * 3
    if own:
        k, i, j = (c[i < j] for c in (k, i, j))
    pairs, pair = np.unique(i * len(y) + j, return_inverse=True)
    best, order = np.zeros(len(pairs)), np.argsort(k, kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(k[order])) + 1) if len(order) else ():
        m, o, n, a, b = tried[k[some[0]]]
        wide = max(1, HELD // (n * 3))
        for part in (some[at : at + wide] for at in range(0, len(some), wide)):
            w = np.zeros((len(part), n))
            w[:, a:b] = 1
            far = superpose(x[i[part], m : m + n], y[j[part], o : o + n], w)
            np.maximum.at(best, pair[part], (1 / (1 + far / half**2)).sum(1) / long)
    return pairs // len(y), pairs % len(y), best


def tm_score(x: np.ndarray, y: np.ndarray, threshold: float = 0.0) -> float:
    """Score of two traces (n, 3); 0 if the lengths can't reach the threshold."""
    x, y = sorted((np.asarray(x, dtype=np.float64), np.asarray(y, dtype=np.float64)), key=len)
    return float(_best(x[None], y[None], threshold)[0])


def _meet(threshold: float):
    """The similar pairs between two tiles, or within one."""

    def run(rows: pa.Table) -> pa.Table:
        ids, flat = rows["id"], rows["xyz"].combine_chunks()
        ends, values = flat.offsets.to_numpy(), flat.values.to_numpy(zero_copy_only=False)
        size, mine = np.diff(ends) // 3, rows["mine"].to_numpy(zero_copy_only=False)
        own = rows["own"][0].as_py()
        left, right = (np.arange(len(size)),) * 2 if own else (np.flatnonzero(mine), np.flatnonzero(~mine))
        found = []
        for n in np.unique(size[left]):
            for m in np.unique(size[right]):
                if min(n, m) < threshold * max(n, m) - 1e-9 or own and n > m:
                    continue
                short, long = left[size[left] == n], right[size[right] == m]
                if n > m:
                    short, long = long, short
                take = lambda k: values[ends[k][:, None] + np.arange(3 * size[k[0]])].reshape(len(k), -1, 3)
                tiny = [_small(take(k), max(scale(max(n, m)), NEAR) / 2) for k in (short, long)]
                rated = tiny[0].sum() * tiny[1].sum() >= FEW
                if rated:
                    a, b = short[tiny[0]], long[tiny[1]]
                    i, j, score = _best_of_small(take(a), take(b), threshold, own and n == m)
                    a, b = a[i], b[j]
                    near = score >= threshold
                    found.append((a[near], b[near], score[near]))
                a, b = (g.ravel() for g in np.meshgrid(short, long, indexing="ij"))
                rest = ~np.logical_and.outer(*tiny).ravel() if rated else np.ones(len(a), dtype=bool)
                if own and n == m:
                    rest &= a < b
                a, b = a[rest], b[rest]
                for at in range(0, len(a), 4096):
                    i, j = a[at : at + 4096], b[at : at + 4096]
                    score = _best(take(i), take(j), threshold)
                    near = score >= threshold
                    found.append((i[near], j[near], score[near]))
        i, j, score = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.empty(0, int), np.empty(0, int), np.empty(0))
        return pa.table({"a": ids.take(pa.array(i)), "b": ids.take(pa.array(j)), "similarity": score})

    return run


def structure_pairs(traces: DataFrame, threshold: float, block: tuple[str, ...] = ()) -> DataFrame:
    """(a, b, similarity) of the pairs of structures (id, xyz, *block) within a block whose score reaches ``threshold``.

    ``xyz`` holds the coordinates of the CA atoms one after another.
    Structures without an id or block, of fewer than ``LEAST`` residues, or
    with a null or non-finite coordinate take no part.
    """
    finite = F.forall("xyz", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False)))
    n = F.floor(F.size("xyz") / 3)
    band = F.floor(F.log(n.cast("double")) / -math.log(threshold)).cast("int")
    fine = traces.where(F.col("id").isNotNull()).dropna(subset=list(block)) if block else traces.where(F.col("id").isNotNull())
    fine = fine.select("id", *block, F.transform("xyz", lambda v: v.cast("double")).alias("xyz")).where(F.col("xyz").isNotNull() & finite & (n >= LEAST)).withColumn("band", band)
    keys = [*block, "band"]
    sizes = materialize(fine.groupBy(*keys).agg(F.ceil(F.count("*") / F.least(F.greatest(F.ceil(F.count("*") / SPREAD), F.lit(TILE)), F.lit(max(TILE, MOST)))).cast("int").alias("tiles")), "structure-bands")
    small = F.broadcast(sizes) if sizes.count() <= BROADCAST_BANDS else sizes
    dealt = fine.join(small, keys).withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")).drop("tiles")
    other = small.select(*block, F.col("band").alias("band2"), F.col("tiles").alias("tiles2"))
    near = dealt.withColumn("band2", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))).join(other, [*block, "band2"])
    near = near.withColumn("tile2", F.explode(F.sequence(F.lit(0), F.col("tiles2") - 1)))
    here, there = F.struct("band", "tile"), F.struct(F.col("band2").alias("band"), F.col("tile2").alias("tile"))
    met = near.select(*block, "id", "xyz", F.least(here, there).alias("lo"), F.greatest(here, there).alias("hi"), (here <= there).alias("mine"), (here == there).alias("own"))
    kind = traces.schema["id"].dataType.simpleString()
    groups = sizes.agg(F.sum(F.col("tiles").cast("long") * F.col("tiles"))).first()[0] or 0
    parts = max(1, min(groups, PARTS))  # told, so that groups of few bytes and much work aren't put together
    pairs = met.repartition(parts, *block, "lo", "hi").groupBy(*block, "lo", "hi").applyInArrow(_meet(threshold), f"a {kind}, b {kind}, similarity double")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity").where("a < b")
