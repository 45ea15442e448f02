"""How far designs are from known sequences: fewest edits, greatest identity, exact copies.

Known sequences are dealt into tiles by range, so that those of a tile share
beginnings, and designs into blocks; a tile and a block meet in a group of
their own.  There the known sequences are a tree of beginnings, and all
designs go down it at once, a residue a step, each with the band of its edit
distances to the beginning that it met; where the band exceeds the edits that
the design may have, the whole branch is left out.  So what known sequences
share is compared once, and no pair is ever listed.

Designs are searched within one edit first, then within two, four and so
on; those that can't get nearer any more leave.  Within one and two edits a
short design meets no tree: what two edits can do to a sequence is a few
hundred keys, and two sequences are that near exactly if they share one, so
a plain semi join finds out, and work grows with the sequences alone.  Joins
are told to shuffle both sides: Spark rates rows by their compressed files and
keys by the rows that they come from, so it would send millions to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.plans.shared import materialize

#: Known sequences, and residues of them, of a tile; designs that go down its tree at once; cells of their bands held at once.
TILE, RESIDUES, TOGETHER, HELD = 32_768, 2_000_000, 512, 1_000_000
#: Designs of a block: a share of all between these bounds; partitions of a search at most.
SHARE, LEAST, MOST, SPREAD = 64, 512, 65_536, 4_096
#: Residues up to which a design is found by keys, and the edits that keys know of.
SHORT, KEYED = 32, 2
#: Sequences of a task that makes the keys of one edit; it takes fewer for two.
AT_ONCE = 20_000
#: More than any distance.
FAR = 1 << 14
#: Names of the values that ``measured`` adds to the metrics.
MUTATIONS, IDENTITY = "mutations_vs_known", "identity_vs_pdb"


def _codes(texts: list[str]) -> np.ndarray:
    """The texts' code points, a row each, filled up with zeros."""
    held = np.array(texts, dtype=np.str_)
    return held.view(np.int32).reshape(len(texts), -1)


class Tree:
    """The beginnings of different sequences, level by level; a beginning is named by its first sequence in order."""

    def __init__(self, texts: list[str]):
        texts = sorted(texts)
        self.lengths = np.array([len(x) for x in texts], dtype=np.int64)
        self.at = np.cumsum(self.lengths) - self.lengths
        self.common = np.full(len(texts), -1, dtype=np.int64)  # residues shared with the sequence before
        step, codes = max(1, HELD // max(int(self.lengths.max(initial=0)), 1)), []
        for lo in range(0, len(texts), step):
            part = _codes(texts[max(lo - 1, 0) : lo + step])
            sizes = self.lengths[max(lo - 1, 0) : lo + step]
            differ = np.column_stack([part[1:] != part[:-1], np.ones(len(part) - 1, dtype=bool)])
            self.common[max(lo, 1) : lo + step] = np.minimum(differ.argmax(axis=1), np.minimum(sizes[1:], sizes[:-1]))
            codes.append(part[np.arange(part.shape[1]) < sizes[:, None]][int(sizes[0]) if lo else 0 :])
        self.codes = np.concatenate(codes) if codes else np.zeros(0, np.int32)
        self.known: dict[int, np.ndarray] = {}

    def starts(self, depth: int) -> np.ndarray:
        """Names of the beginnings of a length, in order."""
        if depth not in self.known:
            self.known[depth] = np.flatnonzero((self.lengths >= depth) & (self.common < depth))
        return self.known[depth]


def nearest(tree: Tree, texts: list[str], budget: np.ndarray, relative: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(numbers of texts, edits, longer lengths): of each text the nearest sequence of the tree within its budget, by edits or by their share of the longer length.

    Parts of the texts may come one by one, and a text several times.
    """
    size, widest = np.array([len(x) for x in texts], dtype=np.int64), int(budget.max())
    width = 2 * widest + 1
    padded = np.full((len(texts), int(max(size.max(), tree.lengths.max())) + width + 1), -1, dtype=np.int32)
    codes = _codes(texts)[:, : size.max()]
    padded[:, widest : widest + codes.shape[1]] = np.where(np.arange(codes.shape[1]) < size[:, None], codes, -1)
    steps = np.arange(width, dtype=np.int16)
    first = np.where(steps >= widest, steps - widest, FAR).astype(np.int16)
    band = np.where(steps[None] - widest > size[:, None], FAR, first[None]).astype(np.int16)
    stack = [(0, np.arange(len(texts)), np.zeros(len(texts), dtype=np.int64), band)] if len(tree.lengths) else []
    while stack:
        depth, who, node, band = stack.pop()
        row = tree.starts(depth)[node]
        cell = size[who] - depth + widest
        whole = (tree.lengths[row] == depth) & (cell >= 0) & (cell < width)
        edits = band[np.flatnonzero(whole), cell[whole]].astype(np.int64)
        near = edits <= budget[who[whole]]
        if near.any():
            found, edits = who[whole][near], edits[near]
            longer = np.maximum(np.maximum(size[found], depth), 1)
            order = np.lexsort((edits / longer if relative else edits, found))
            keep = order[np.r_[True, found[order][1:] != found[order][:-1]]]
            yield found[keep], edits[keep], longer[keep]
        below = tree.starts(depth + 1)
        lo = np.searchsorted(below, row)
        ends = np.r_[tree.starts(depth), len(tree.lengths)][node + 1]
        many = np.searchsorted(below, ends) - lo
        step = max(1, HELD // width)
        upto = np.cumsum(many)
        cuts = np.searchsorted(upto, np.arange(step, upto[-1] + step, step), side="right") if len(upto) else []
        for a, b in zip([0, *cuts], [*cuts, len(many)], strict=True):
            if a >= b or not (total := int(many[a:b].sum())):
                continue
            old = np.repeat(np.arange(a, b), many[a:b])
            child = lo[old] + np.arange(total) - np.repeat(np.cumsum(many[a:b]) - many[a:b], many[a:b])
            mine, letter = who[old], tree.codes[tree.at[below[child]] + depth]
            before = band[old]
            new = before + (padded[:, depth : depth + width][mine] != letter[:, None])
            np.minimum(new[:, :-1], before[:, 1:] + 1, out=new[:, :-1])
            new = (np.minimum.accumulate(new - steps, axis=1) + steps).astype(np.int16)
            new[steps[None] + (depth + 1 - widest) > size[mine, None]] = FAR
            np.minimum(new, FAR, out=new)
            alive = new.min(axis=1) <= budget[mine]
            if alive.any():
                stack.append((depth + 1, mine[alive], child[alive], new[alive]))


def _meet(relative: bool):
    """Of each design of a block the nearest sequence of a tile within its budget."""

    def run(designs: pa.Table, known: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if designs.num_rows and known.num_rows:
            tree = Tree(known["other"].to_pylist())
            texts, budget = designs["sequence"].to_pylist(), designs["budget"].to_numpy()
            order = np.argsort([len(x) for x in texts], kind="stable")
            for at in range(0, len(order), TOGETHER):
                part = order[at : at + TOGETHER]
                for who, edits, longer in nearest(tree, [texts[i] for i in part], budget[part], relative):
                    out += zip([texts[i] for i in part[who]], edits.tolist(), longer.tolist(), strict=True)
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], ["sequence", "edits", "longer"])

    return run


def _without(text: Column, i: Column) -> Column:
    return F.concat(F.substr(text, F.lit(1), i - 1), F.substr(text, i + 1))


def _places(text: Column, make) -> Column:
    """What ``make`` makes of every place of a text; nothing of an empty one."""
    return F.when(F.length(text) > 0, F.transform(F.sequence(F.lit(1), F.length(text)), make)).otherwise(F.array().cast("array<string>"))


def _dropped(text: Column) -> Column:
    """The text without one residue, for every residue."""
    return F.array_distinct(_places(text, lambda i: _without(text, i)))


def _holes(text: Column) -> Column:
    """The text with one residue unknown, for every residue; its place is told."""
    return _places(text, lambda i: F.concat(i.cast("string"), F.lit(":"), _without(text, i)))


def _two_holes(text: Column) -> Column:
    later = lambda i: F.transform(F.sequence(i + 1, F.length(text)), lambda j: F.concat(i.cast("string"), F.lit(","), j.cast("string"), F.lit(":"), _without(_without(text, j), i)))
    return F.when(F.length(text) > 1, F.flatten(F.transform(F.sequence(F.lit(1), F.length(text) - 1), later))).otherwise(F.array().cast("array<string>"))


def _twice(text: Column, make) -> Column:
    return F.array_distinct(F.flatten(F.transform(_dropped(text), make)))


def _itself(text: Column) -> Column:
    return F.array(text)


#: Ways from a design to a known sequence: edits, residues that the known one has more, and the keys of both, which are equal exactly if the way exists.
WAYS = {
    "=": (0, 0, _itself, _itself),
    "s": (1, 0, _holes, _holes), "i": (1, 1, _itself, _dropped), "d": (1, -1, _dropped, _itself),
    "ss": (2, 0, _two_holes, _two_holes), "id": (2, 0, _dropped, _dropped), "is": (2, 1, _holes, lambda t: _twice(t, _holes)), "ds": (2, -1, lambda t: _twice(t, _holes), _holes),
    "ii": (2, 2, _itself, lambda t: _twice(t, _dropped)), "dd": (2, -2, lambda t: _twice(t, _dropped), _itself),
}


def _by_keys(designs: DataFrame, known: DataFrame, many: tuple[int, int], limit: int, worth: Column) -> DataFrame:
    """(sequence, edits, longer): the nearest known sequence (other) within ``limit`` edits, ``KEYED`` at most, of short designs (sequence, n, most).

    ``many`` are the rows of both.  Keys are made only of sequences of lengths that the other table has a partner for.
    """
    designs, known = (x.repartition(min(max(1, n * limit * limit // AT_ONCE), SPREAD)) for x, n in zip((designs, known), many, strict=True))  # told: narrow rows that become many
    lengths = lambda rows, n: [r["n"] for r in rows.select(n.alias("n")).where(F.col("n") <= SHORT + KEYED).distinct().collect()]  # noqa: E731 - one row a length
    ours, theirs = lengths(designs, F.col("n")), lengths(known, F.length("other").cast("long"))
    tag = lambda way, keys: F.transform(keys, lambda k: F.concat(F.lit(way + "|"), k))
    none, asks, held = F.array().cast("array<string>"), [], []
    for way, (edits, more, of_design, of_known) in WAYS.items():
        meet = [n for n in ours if n + more in theirs]
        if edits > limit or not meet:
            continue
        told = lambda keys, e=edits, m=more: F.transform(keys, lambda k: F.struct(k.alias("key"), F.lit(e).cast("long").alias("edits"), F.greatest(F.col("n") + max(m, 0), F.lit(1)).alias("longer")))
        made = F.when(F.col("n").isin(meet) & (F.col("most") >= edits), tag(way, of_design(F.col("sequence")))).otherwise(none)
        asks.append(told(made))
        held.append(F.when(F.length("other").isin([n + more for n in meet]), tag(way, of_known(F.col("other")))).otherwise(none))
    if not asks:
        return designs.select("sequence", F.lit(0).cast("long").alias("edits"), F.lit(0).cast("long").alias("longer")).limit(0)
    left = designs.select("sequence", F.explode(F.concat(*asks)).alias("k")).select("sequence", "k.*")
    right = known.select(F.explode(F.concat(*held)).alias("key"))
    met = left.join(right.hint("merge"), "key", "left_semi")
    return met.groupBy("sequence").agg(F.min_by(F.struct("edits", "longer"), worth).alias("b")).select("sequence", "b.edits", "b.longer")


def _by_trees(open_: DataFrame, right: DataFrame, tiles: int, limit: int, relative: bool, worth: Column) -> DataFrame | None:
    """(sequence, edits, longer): the nearest known sequence of the tiles within ``limit`` edits; None without designs."""
    many = open_.count()
    if not many:
        return None
    block = min(max(-(-many // SHARE), LEAST), MOST)
    blocks = -(-many // block)
    asks = open_.select("sequence", F.least("most", F.lit(limit)).alias("budget"), F.pmod(F.xxhash64("sequence"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"))
    held = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    parts = min(tiles * blocks, SPREAD)  # told, so that small groups of much work aren't put together
    asks, held = (x.repartition(parts, "tile", "block") for x in (asks, held))
    met = asks.groupBy("tile", "block").cogroup(held.groupBy("tile", "block")).applyInArrow(_meet(relative), "sequence string, edits long, longer long")
    return met.groupBy("sequence").agg(F.min_by(F.struct("edits", "longer"), worth).alias("b")).select("sequence", "b.edits", "b.longer")


def _nearest(designs: DataFrame, known: DataFrame, most: Column, relative: bool) -> DataFrame:
    """(sequence, edits, longer): the nearest known sequence of the designs that have one within ``most`` edits, an expression of the length ``n``.

    Null sequences take no part; empty ones do.
    """
    left = designs.select("sequence").where("sequence is not null").distinct().withColumn("n", F.length("sequence").cast("long")).withColumn("most", most.cast("long"))
    open_ = materialize(left.where("most >= 0"), "novelty-designs")
    right = materialize(known.select(F.col("sequence").alias("other")).where("other is not null").distinct(), "novelty-known")
    size = right.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("other")), F.lit(0)).alias("residues")).first()
    tiles = max(1, -(-size["n"] // TILE), -(-size["residues"] // RESIDUES))
    right = materialize(right.repartitionByRange(tiles, "other").withColumn("tile", F.spark_partition_id()), "novelty-tiles")
    worth = F.col("edits") / F.col("longer") if relative else F.col("edits")
    limit, settled = 1, None
    while True:
        told = open_.agg(F.count("*").alias("n"), F.max("most").alias("most")).first()
        if not told["n"]:
            break
        keyed = limit <= KEYED
        best = _by_trees(open_.where(F.col("n") > SHORT) if keyed else open_, right, tiles, limit, relative, worth)
        if keyed:
            found = _by_keys(open_.where(F.col("n") <= SHORT), right, (told["n"], size["n"]), limit, worth)
            best = found if best is None else best.unionByName(found)
        # With more edits than the limit a known sequence has at most as many residues more than the design.
        after = F.lit(limit + 1) / (F.col("n") + limit + 1) if relative else F.lit(limit + 1)
        rated = materialize(open_.join(best.hint("merge"), "sequence", "left").withColumn("done", (F.col("most") <= limit) | F.coalesce(worth <= after, F.lit(False))), "novelty-rated")
        part = rated.where("done and edits is not null").select("sequence", "edits", "longer")
        settled = part if settled is None else settled.unionByName(part)
        open_ = rated.where("not done").select("sequence", "n", "most")
        if told["most"] <= limit:
            break
        limit *= 2
    return settled if settled is not None else open_.select("sequence", F.lit(0).cast("long").alias("edits"), F.lit(0).cast("long").alias("longer")).limit(0)


def fewest_mutations(designs: DataFrame, known: DataFrame, least: int) -> DataFrame:
    """(sequence, mutations): edits to the nearest known sequence of the designs that have one within ``least - 1``."""
    return _nearest(designs, known, F.lit(least - 1), False).select("sequence", F.col("edits").alias("mutations"))


def greatest_identity(designs: DataFrame, known: DataFrame, most: float) -> DataFrame:
    """(sequence, identity): one less the edits by the longer length, to the nearest known sequence, of the designs whose identity reaches ``most``."""
    edits = F.floor(F.col("n") * (1 - most) / most + 1e-9) if most > 0 else F.lit(FAR)
    near = _nearest(designs, known, edits, True)
    return near.select("sequence", (1 - F.col("edits") / F.col("longer")).alias("identity")).where(F.col("identity") >= most)


def copies(designs: DataFrame, lists: dict[str, DataFrame]) -> DataFrame:
    """(sequence, copy_of): names of the lists that hold a design's sequence, sorted."""
    own = designs.select("sequence").where("sequence is not null").distinct()
    found = [own.join(rows.select("sequence").distinct().hint("merge"), "sequence").withColumn("name", F.lit(name)) for name, rows in lists.items()]
    every = found[0] if found else own.limit(0).withColumn("name", F.lit(""))
    for more in found[1:]:
        every = every.union(more)
    return every.groupBy("sequence").agg(F.array_sort(F.collect_set("name")).alias("copy_of"))  # no more than there are lists


def measured(designs: DataFrame, profile: dict, known: DataFrame | None = None, pdb: DataFrame | None = None, lists: dict[str, DataFrame] | None = None) -> DataFrame:
    """Decoded designs whose metrics tell what the profile's section ``novelty`` asks for, with a column ``copy_of`` of the forbidden lists that have their sequence.

    Each reference is a table with a column ``sequence``; without it nothing
    is told.  A design far from all known ones is told the limit: at least so
    many mutations, an identity of 0.  What was measured before is replaced.
    """
    rules, wanted, out = profile.get("novelty") or {}, (profile.get("peptide_specific") or {}).get("disallow_exact_duplicate_of") or (), designs
    least, most = rules.get("min_mutations_vs_known_binders"), rules.get("max_identity_vs_pdb")
    told = {}
    if known is not None and least is not None:
        out = out.join(fewest_mutations(designs, known, int(least)).hint("merge"), "sequence", "left")
        told[MUTATIONS] = F.coalesce("mutations", F.lit(int(least)))
    if pdb is not None and most is not None:
        out = out.join(greatest_identity(designs, pdb, float(most)).hint("merge"), "sequence", "left")
        told[IDENTITY] = F.coalesce("identity", F.lit(0.0))
    out = out.join(copies(designs, {n: rows for n, rows in (lists or {}).items() if n in wanted}).hint("merge"), "sequence", "left").withColumn("copy_of", F.coalesce("copy_of", F.array().cast("array<string>")))
    if told:
        others = F.map_filter("metrics", lambda k, v: ~F.lower(k).isin(*told))
        out = out.withColumn("metrics", F.map_concat(others, F.create_map(*[x for k, v in told.items() for x in (F.lit(k), v.cast("double"))])))
    return out.select(*designs.columns, "copy_of")
